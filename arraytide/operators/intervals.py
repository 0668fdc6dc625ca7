"""Samples against interval lists: masks, keep fractions and named windows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .blocks import block_of
from .islands import merge_intervals

SLOT = 600


def in_intervals(samples: DataFrame, intervals: DataFrame, keys: list[str], pos: str, start: str, end: str,
                 slot: int = SLOT, how: str = "left_anti", closed: bool = False) -> DataFrame:
    """Samples outside ('left_anti') or inside ('left_semi') the union of the intervals of their key.

    The intervals are merged first, so they are disjoint; each is then cut at multiples of `slot` and met on
    (key, slot). A sample meets only the pieces of its own slot and is emitted at most once, and a hot station
    is split by the adaptive skew join because neither side is grouped afterwards. [start, end) unless `closed`.
    """
    last = F.col(end) if closed else F.col(end) - 1
    iv = intervals.select(*keys, F.col(start).cast("bigint").alias("_a"), last.cast("bigint").alias("_b"))
    iv = merge_intervals(iv.where(F.col("_b") >= F.col("_a")), keys, "_a", "_b", block=slot * 256)
    iv = iv.withColumn("_slot", F.explode(F.sequence(block_of("_a", slot), block_of("_b", slot))))
    iv = iv.select(*[F.col(k).alias("_k_" + k) for k in keys], "_slot", "_a", "_b")
    s = samples.withColumn("_pslot", block_of(pos, slot))
    cond = F.col("_pslot") == F.col("_slot")
    for k in keys:
        cond = cond & (F.col(k) == F.col("_k_" + k))
    cond = cond & (F.col(pos) >= F.col("_a")) & (F.col(pos) <= F.col("_b"))
    return s.join(iv, cond, how).drop("_pslot")


def mark(samples: DataFrame, intervals: DataFrame, keys: list[str], pos: str, start: str, end: str, out: str,
         slot: int = SLOT, closed: bool = False) -> DataFrame:
    """Every sample with a boolean `out`, true inside an interval."""
    last = F.col(end) if closed else F.col(end) - 1
    iv = intervals.select(*keys, F.col(start).cast("bigint").alias("_a"), last.cast("bigint").alias("_b"))
    iv = merge_intervals(iv.where(F.col("_b") >= F.col("_a")), keys, "_a", "_b", block=slot * 256)
    iv = iv.withColumn("_slot", F.explode(F.sequence(block_of("_a", slot), block_of("_b", slot))))
    # pieces of one slot, bounded by the positions of a slot because they are disjoint
    per = iv.groupBy(*keys, "_slot").agg(F.collect_list(F.struct("_a", "_b")).alias("_iv"))
    s = samples.withColumn("_slot", block_of(pos, slot)).join(per, [*keys, "_slot"], "left")
    hit = F.exists("_iv", lambda p: (F.col(pos) >= p["_a"]) & (F.col(pos) <= p["_b"]))
    return s.withColumn(out, F.coalesce(hit, F.lit(False))).drop("_slot", "_iv")


def keep_fractions(samples: DataFrame, keys: list[str], finite: Column, in_event: Column, covered: Column,
                   selected: Column) -> DataFrame:
    """The ordered cost of each mask: finite, then events, then reference coverage, then the selection.

    One aggregate pass; each later fraction is charged only for what the earlier masks left.
    """
    f = finite
    m = f & ~in_event
    r = m & covered
    s = r & selected
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return (samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), share(f).alias("finite_frac"),
                                       share(m).alias("_m"), share(r).alias("_r"), share(s).alias("kept_frac"))
            .withColumns({"transient_dropped_frac": F.col("finite_frac") - F.col("_m"),
                          "reference_coverage_dropped_frac": F.col("_m") - F.col("_r"),
                          "selection_dropped_frac": F.col("_r") - F.col("kept_frac"),
                          "mask_dropped_frac": 1 - F.col("kept_frac")}).drop("_m", "_r"))


def half_of(pos: Column, t0: Column, n: Column) -> Column:
    """half1 or half2 by sample index, split at the integer midpoint."""
    return F.when(pos - t0 < F.floor(n / 2), "half1").otherwise("half2")


def named_window(spec: Column) -> dict[str, Column]:
    """`window:<ISO UTC start>/<hours>` as typed bounds, or the reason it does not read."""
    body = F.regexp_extract(spec, r"^[^:]*:(.*)$", 1)
    start = F.regexp_extract(body, r"^(.*)/([^/]*)$", 1)
    hours = F.regexp_extract(body, r"^(.*)/([^/]*)$", 2).try_cast("double")
    ts = F.unix_seconds(F.trim(start).try_cast("timestamp"))
    ok = ts.isNotNull() & hours.isNotNull() & (hours > 0)
    return {"t_start": F.when(ok, ts), "t_end": F.when(ok, (ts + hours * 3600).cast("bigint")),
            "hours": F.when(ok, hours).otherwise(F.lit(0.0)),
            "reason": F.when(ok, F.lit("the stretch named in the recipe"))
            .otherwise(F.concat(spec, F.lit(" does not read as window:<ISO UTC start>/<hours>")))}


def regimes(cell: Column) -> Column:
    """`a:b c:` in days to an array of (day0, day1) structs; an open end is NULL, unreadable items are dropped."""
    low = F.lower(F.trim(cell))
    items = F.split(F.regexp_replace(F.trim(cell), ",", " "), r"\s+")
    def one(x):
        a, b = F.regexp_extract(x, "^([^:]*):(.*)$", 1), F.regexp_extract(x, "^([^:]*):(.*)$", 2)
        return F.struct(F.when(a == "", F.lit(0.0)).otherwise(a.try_cast("double")).alias("day0"),
                        b.try_cast("double").alias("day1"),
                        (x.contains(":") & ((a == "") | a.try_cast("double").isNotNull())
                         & ((b == "") | b.try_cast("double").isNotNull())).alias("ok"))
    got = F.transform(F.filter(F.transform(items, one), lambda r: r["ok"]),
                      lambda r: F.struct(r["day0"].alias("day0"), r["day1"].alias("day1")))
    return F.when(low.isin("", "nan", "none", "decide"), F.filter(got, lambda r: F.lit(False))).otherwise(got)
