"""Sample-level screens and robust windows on the dense axis of a record."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .axis import AXIS_BLOCK, first_differences
from .blocks import BLK, block_of, carry_in, trim_halo, with_halo
from .quantiles import group_mad

DESPIKE_K = 30.0
LANCZOS_A = 16
STEP = 2.0


def _within(keys: list[str], pos: str):
    return Window.partitionBy(*keys, BLK).orderBy(pos)


def despike(samples: DataFrame, keys: list[str], pos: str, value: str, k: float = DESPIKE_K, before: int = 2, after: int = 3,
            min_finite: int = 10, block: int = AXIS_BLOCK) -> DataFrame:
    """Blank samples i-2 .. i+3 round every one-sample step beyond k times the robust scale of the steps.

    The scale is 1.4826 x MAD of the first differences of the record. Adds `blanked`; a record with fewer than
    ten differences is left as it is.
    """
    d = first_differences(samples.select(*keys, pos, value), keys, pos, value, "_d", block)
    scale = group_mad(d.where(F.col("_d").isNotNull()), keys, "_d").select(*keys, F.col("mad").alias("_mad"))
    n = d.groupBy(*keys).agg(F.count("_d").alias("_nd"), F.count(value).alias("_nv"))
    lim = scale.join(n, keys).where((F.col("_nd") >= min_finite) & (F.col("_nv") >= min_finite)).drop("_nd", "_nv")
    x = samples.join(lim, keys, "left")
    x = with_halo(x, pos, block, after, before + 1)
    w = _within(keys, pos)
    step = F.abs(F.lead(value).over(w) - F.col(value))
    x = x.withColumn("_hit", F.coalesce(step > F.lit(k) * F.col("_mad") + 1e-9, F.lit(False)))
    x = x.withColumn("blanked", F.max("_hit").over(w.rowsBetween(-after, before)))
    return trim_halo(x.withColumn(value, F.when(~F.col("blanked"), F.col(value))), pos, block).drop("_hit", "_mad")


def fill_short(samples: DataFrame, keys: list[str], pos: str, value: str, max_gap: int = 600, block: int = AXIS_BLOCK) -> DataFrame:
    """Linear fill of gaps of at most `max_gap` samples; a gap touching either end of the record is never filled.

    Adds `filled`. A gap that short lies inside the halo, so nothing further away is looked at.
    """
    d = with_halo(samples, pos, block, max_gap + 1, max_gap + 1)
    w = _within(keys, pos)
    pv = F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))
    d = d.withColumn("_b", F.last(pv, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_a", F.first(pv, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    gap = F.col("_a.p") - F.col("_b.p") - 1
    can = F.col(value).isNull() & F.coalesce(gap <= max_gap, F.lit(False))
    line = F.col("_b.v") + (F.col("_a.v") - F.col("_b.v")) * (F.col(pos) - F.col("_b.p")) / (F.col("_a.p") - F.col("_b.p"))
    d = d.withColumn("filled", can).withColumn(value, F.when(F.col("filled"), line).otherwise(F.col(value)))
    return trim_halo(d.drop("_a", "_b"), pos, block)


def widen_gaps(samples: DataFrame, keys: list[str], pos: str, value: str, k: int, block: int = AXIS_BLOCK) -> DataFrame:
    """Every gap widened by k samples at each end: the recorder's settling goes with it."""
    d = with_halo(samples, pos, block, k, k)
    near = F.max(F.col(value).isNull()).over(_within(keys, pos).rowsBetween(-k, k))
    return trim_halo(d.withColumn(value, F.when(~near, F.col(value))), pos, block)


def screen_edges(samples: DataFrame, keys: list[str], pos: str, value: str, k: int, block: int = AXIS_BLOCK) -> DataFrame:
    """Blank k samples inside every finite run: both record ends and both sides of every gap.

    A sample stays exactly where it and k neighbours on either side are all there.
    """
    d = with_halo(samples, pos, block, k, k)
    whole = F.count(value).over(_within(keys, pos).rowsBetween(-k, k)) == 2 * k + 1
    return trim_halo(d.withColumn(value, F.when(whole, F.col(value))), pos, block)


def lanczos_weights(f: float, a: int = LANCZOS_A) -> list[float]:
    """Normalised taps -a+1 .. a of the sinc delayed by the fraction f."""
    def sinc(x: float) -> float:
        return 1.0 if x == 0 else math.sin(math.pi * x) / (math.pi * x)
    w = [sinc(t - f) * sinc((t - f) / a) for t in range(-a + 1, a + 1)]
    total = sum(w)
    return [x / total for x in w]


def lanczos_raw(f: Column, a: int = LANCZOS_A) -> Column:
    """The same taps before normalisation as an array column, for a delay that differs per record."""
    def sinc(x: Column) -> Column:
        return F.when(x == 0, F.lit(1.0)).otherwise(F.sin(x * math.pi) / (x * math.pi))
    return F.transform(F.sequence(F.lit(-a + 1), F.lit(a)), lambda t: sinc(t - f) * sinc((t - f) / a))


def shift(samples: DataFrame, keys: list[str], pos: str, value: str, delay: float | Column, block: int = AXIS_BLOCK,
          a: int = LANCZOS_A) -> DataFrame:
    """The record advanced by `delay` samples: out[i] = x[i + delay], an integer relabelling and a local sinc.

    A missing sample reaches only the 2a samples round it. A column delay has to be constant within a record.
    """
    taps = range(-a + 1, a + 1)
    if isinstance(delay, (int, float)):
        k, f = math.floor(delay), delay - math.floor(delay)
        d = samples.withColumn(pos, F.col(pos) - k)
        if f == 0:
            return d
        weights = [F.lit(x) for x in lanczos_weights(f, a)]
    else:
        d = samples.withColumn("_dl", F.coalesce(delay, F.lit(0.0)))
        d = d.withColumn("_f", F.col("_dl") - F.floor("_dl")).withColumn(pos, F.col(pos) - F.floor("_dl"))
        # the taps are worked out once per distinct fraction and not once per sample
        taps_of = d.select("_f").distinct().withColumn("_w", lanczos_raw(F.col("_f"), a))
        taps_of = taps_of.withColumn("_s", F.aggregate("_w", F.lit(0.0), lambda s, x: s + x))
        d = d.join(taps_of, "_f")
        weights = [F.col("_w")[j] for j in range(2 * a)]
    d = with_halo(d, pos, block, a, a)
    w = _within(keys, pos)
    total = None
    for t, wt in zip(taps, weights):
        x = F.lead(value, t).over(w) if t > 0 else F.lag(value, -t).over(w) if t < 0 else F.col(value)
        total = wt * x if total is None else total + wt * x
    if not isinstance(delay, (int, float)):
        total = F.when(F.col("_f") == 0, F.col(value)).otherwise(total / F.col("_s"))
    return trim_halo(d.withColumn("_out", total), pos, block).withColumn(value, F.col("_out")).drop("_out", "_dl", "_f", "_w", "_s")


def rolling_median(samples: DataFrame, keys: list[str], pos: str, value: str, before: int, after: int, out: str,
                   block: int = AXIS_BLOCK) -> DataFrame:
    """Median of the finite values of a frame round each position; one is enough."""
    d = with_halo(samples, pos, block, before, after)
    med = F.percentile(value, 0.5).over(_within(keys, pos).rowsBetween(-before, after))
    return trim_halo(d.withColumn(out, med), pos, block)


def steps_per_million(samples: DataFrame, keys: list[str], pos: str, value: str, step: float = STEP,
                      block: int = AXIS_BLOCK) -> DataFrame:
    """Steps larger than `step` per million between consecutive finite samples, steps across gaps included."""
    d = samples.where(F.col(value).isNotNull()).select(*keys, pos, value).withColumn(BLK, block_of(pos, block))
    d = carry_in(d, keys, pos, {"_lv": F.max_by(value, pos)}, {"_lv": "last"})
    prev = F.coalesce(F.lag(value).over(_within(keys, pos)), F.col("_in__lv"))
    d = d.withColumn("_d", F.abs(F.col(value) - prev))
    return d.groupBy(*keys).agg(F.count_if(F.col("_d") > step).alias("n_steps"), F.count("_d").alias("n_diffs")).withColumn(
        "per_million", F.lit(1e6) * F.col("n_steps") / F.greatest(F.col("n_diffs"), F.lit(1)))


def blank_decimated(samples: DataFrame, keys: list[str], pos: str, value: str, q: int) -> DataFrame:
    """Blocks of q positions with any sample missing: the outputs a decimation by q has to leave empty."""
    return (samples.groupBy(*keys, block_of(pos, q).alias("slot"))
            .agg((F.count(value) < q).alias("blank"), F.count(value).alias("n")))
