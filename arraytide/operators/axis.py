"""Records on one absolute regular axis: placement, dense axes, alignment, spans and rate changes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import block_of

AXIS_BLOCK = 86_400


def place(rows: DataFrame, keys: list[str], pos: str, values: list[str], order: list[str]) -> DataFrame:
    """One row per (keys, pos): the later row wins, and how many rows were read for the position.

    An aggregate and not a row_number window, so repeated writes of one position merge before the shuffle and a
    position written over and over cannot fill one task.
    """
    last = F.max_by(F.struct(*values), F.struct(*order))
    return (rows.groupBy(*keys, pos).agg(last.alias("_w"), F.count(F.lit(1)).alias("n_read"))
            .select(*keys, pos, *[F.col("_w")[v].alias(v) for v in values], "n_read"))


def axis_of(spans: DataFrame, keys: list[str], lo: str, hi: str, pos: str, block: int = AXIS_BLOCK) -> DataFrame:
    """Every position lo..hi of each key, made block by block so that no key's axis is built in one row."""
    d = spans.select(*keys, F.col(lo).cast("bigint").alias("_lo"), F.col(hi).cast("bigint").alias("_hi"))
    d = d.withColumn("_b", F.explode(F.sequence(block_of("_lo", block), block_of("_hi", block))))
    a = F.greatest(F.col("_lo"), F.col("_b") * block)
    b = F.least(F.col("_hi"), F.col("_b") * block + (block - 1))
    return d.repartition(*[F.col(k) for k in keys], F.col("_b")).select(
        *keys, F.explode(F.sequence(a, b)).alias(pos))


def densify(samples: DataFrame, keys: list[str], pos: str, values: list[str], spans: DataFrame | None = None,
            block: int = AXIS_BLOCK) -> DataFrame:
    """Samples on the dense axis from their first to their last position, NULL where nothing was recorded."""
    if spans is None:
        spans = samples.groupBy(*keys).agg(F.min(pos).alias("_a"), F.max(pos).alias("_z"))
        lo, hi = "_a", "_z"
    else:
        lo, hi = spans.columns[-2:]
    full = axis_of(spans, keys, lo, hi, pos, block)
    return full.join(samples.select(*keys, pos, *values), [*keys, pos], "left")


def reconcile(rows: DataFrame, keys: list[str], pos: str, in_axis: Column | None = None) -> DataFrame:
    """What was read, placed, written twice or fell outside the axis, with the PASS / FAIL verdict.

    `rows` is one row per sample read, before placement.
    """
    ok = F.lit(True) if in_axis is None else in_axis
    per = rows.groupBy(*keys, pos).agg(F.count(F.lit(1)).alias("_n"), F.count_if(ok).alias("_in"))
    out = per.groupBy(*keys).agg(
        F.sum("_n").alias("samples_read"), F.sum("_in").alias("samples_placed"),
        F.sum(F.greatest(F.col("_in") - 1, F.lit(0))).alias("overlap_samples"),
        F.sum(F.col("_n") - F.col("_in")).alias("unplaced_samples"))
    good = ((F.col("samples_placed") == F.col("samples_read")) & (F.col("overlap_samples") == 0)
            & (F.col("unplaced_samples") == 0))
    return out.withColumn("verdict", F.when(good, "PASS").otherwise("FAIL"))


def on_grid(target: DataFrame, source: DataFrame, keys: list[str], pos: str, values: list[str],
            offset: Column | int = 0) -> DataFrame:
    """A source record on another record's axis at the same rate, NULL outside the overlap."""
    src = source.withColumn(pos, F.col(pos) + (F.lit(offset) if isinstance(offset, int) else offset))
    return target.select(*keys, pos).join(src.select(*keys, pos, *values), [*keys, pos], "left")


def extent(samples: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """First position, number of axis positions and recorded samples of each record."""
    return (samples.groupBy(*keys).agg(F.min(pos).alias("t0"), F.max(pos).alias("_z"), F.count(F.lit(1)).alias("n_rows"))
            .withColumn("n", F.col("_z") - F.col("t0") + 1).drop("_z"))


def whole_blocks(samples: DataFrame, keys: list[str], pos: str, step: int, values: list[str]) -> DataFrame:
    """The grid blocks a record holds whole and finite, aligned to multiples of `step`; partial ones never appear."""
    full = F.lit(True)
    for v in values:
        full = full & F.col(v).isNotNull()
    return (samples.where(full).groupBy(*keys, block_of(pos, step).alias("slot"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == step))


def block_stats(samples: DataFrame, keys: list[str], pos: str, value: str, step: int) -> DataFrame:
    """Mean, minimum and maximum of every `step` positions."""
    return (samples.groupBy(*keys, block_of(pos, step).alias("slot"))
            .agg(F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"),
                 F.count(value).alias("n")))


def zero_order_hold(coarse: DataFrame, keys: list[str], pos: str, factor: int) -> DataFrame:
    """Each coarse sample held for `factor` fine positions, as the one-second archive is on a 10 Hz grid."""
    return coarse.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(factor - 1)))).withColumn(
        pos, (F.col(pos) * factor + F.col("_k")).cast("bigint")).drop("_k")


def unit_gains(samples: DataFrame, h_uv_per_nt: float = 142.857, hz_divider: float = 0.4, e_gain: float = 10.0,
               dipole_n: str = "dipole_n_m", dipole_e: str = "dipole_e_m") -> DataFrame:
    """Recorder microvolts to nT and mV/km; a channel whose gain is missing or zero is left raw."""
    def div(c: str, g: Column) -> Column:
        return F.when(g.isNotNull() & (g != 0), F.col(c) / g).otherwise(F.col(c))
    h = F.lit(h_uv_per_nt)
    return samples.withColumns({
        "hx": div("hx", h), "hy": div("hy", h), "hz": div("hz", h * F.lit(hz_divider)),
        "ex": div("ex", F.col(dipole_n) * e_gain), "ey": div("ey", F.col(dipole_e) * e_gain)})


def first_differences(samples: DataFrame, keys: list[str], pos: str, value: str, out: str = "d",
                      block: int = AXIS_BLOCK) -> DataFrame:
    """x[i+1] - x[i] on the dense axis, NULL where either is missing."""
    from .blocks import BLK, trim_halo, with_halo
    w = Window.partitionBy(*keys, BLK).orderBy(pos)
    d = with_halo(samples, pos, block, 0, 1)
    return trim_halo(d.withColumn(out, F.lead(value).over(w) - F.col(value)), pos, block)
