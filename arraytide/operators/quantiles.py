"""Exact order statistics of groups of any size.

Spark's `percentile` keeps a value -> count map of the whole group in one reducer. That is the right plan for
groups that are bounded by construction (a day of one channel, the periods of one curve) and the wrong one for
a group that may hold a third of all rows, such as every sample of one station.

`value_ranks` gives the rank of every value without holding a group in one task; percentiles and medians are read off it:

    1  collapse to distinct (key, value) with a count: ties merge before any shuffle by key
    2  cut every key's values into buckets at sketch quantiles (bounded, mergeable state)
    3  number the values inside (key, bucket) and add the counts of the lower buckets

Sketch error moves a bracket or a cut point, never a result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 256


def value_ranks(df: DataFrame, keys: list[str], value: str, buckets: int = BUCKETS) -> DataFrame:
    """Distinct (keys, value) with the 1-based ranks lo..hi it occupies in its group and the group size n."""
    d = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
         .agg(F.count(F.lit(1)).alias("_c")))
    probs = [k / buckets for k in range(1, buckets)]
    cuts = d.groupBy(*keys).agg(F.percentile_approx("_v", probs, 20 * buckets).alias("_cuts"))
    d = d.join(cuts, keys).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    per = d.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_b", F.coalesce(F.sum("_bc").over(w), F.lit(0)).alias("_off"),
                     F.sum("_bc").over(Window.partitionBy(*keys)).alias("n"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v")
    return (d.join(per, [*keys, "_b"])
            .withColumn("hi", F.col("_off") + F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("lo", F.col("hi") - F.col("_c") + 1)
            .select(*keys, F.col("_v").alias(value), "lo", "hi", "n"))


def group_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], buckets: int = BUCKETS) -> DataFrame:
    """{name: p} interpolated percentiles of `value` per group: the values at the two ranks beside p (n - 1), by `value_ranks`.

    One plan for every size of group. No group is gathered, and the ranks are counted, never estimated.
    """
    ranks = value_ranks(df.select(*keys, F.col(value).cast("double").alias("_v")), keys, "_v", buckets)
    at = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probs.items()}

    def stands(rank: Column, name: str) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (F.col("hi") >= rank), F.col("_v"))).alias(name)

    g = ranks.groupBy(*keys).agg(F.max("n").alias("n"), *[c for name, x in at.items() for c in (stands(F.floor(x) + 1, f"_a_{name}"), stands(F.ceil(x) + 1, f"_b_{name}"))])
    return g.select(*keys, *[(F.col(f"_a_{name}") + (x - F.floor(x)) * (F.col(f"_b_{name}") - F.col(f"_a_{name}"))).alias(name) for name, x in at.items()])


def group_mad(df: DataFrame, keys: list[str], value: str, scale: float = 1.4826) -> DataFrame:
    """(keys, med, mad): the median and the scaled median absolute deviation of each group, in two passes."""
    med = group_percentiles(df, keys, value, {"med": 0.5})
    dev = df.select(*keys, value).join(med, keys).withColumn("_dev", F.abs(F.col(value) - F.col("med")))
    return (group_percentiles(dev, keys, "_dev", {"mad": 0.5}).join(med, keys)
            .withColumn("mad", F.col("mad") * F.lit(scale)))


def others_median(df: DataFrame, keys: list[str], value: str, out: str = "others_median",
                  buckets: int = 16) -> DataFrame:
    """Each row of `df` with the median of the other rows of its group, without a self-join.

    Leaving one value out moves the median by at most one place, so the three middle order statistics of the
    group answer for every row of it: a row at or below the middle sees the upper ones, a row above the lower.
    """
    ranks = value_ranks(df, keys, value, buckets)
    n = F.col("n")

    def at(rank: Column, name: str) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (F.col("hi") >= rank), F.col(value))).alias(name)

    half = F.floor(n / 2)
    mid = ranks.groupBy(*keys).agg(F.max("n").alias("_n"), at(half, "_m0"), at(half + 1, "_m1"), at(half + 2, "_m2"))
    v = F.col(value)
    even = F.when(v <= F.col("_m0"), F.col("_m1")).otherwise(F.col("_m0"))
    odd = (F.when(v <= F.col("_m0"), (F.col("_m1") + F.col("_m2")) / 2)
           .when(v >= F.col("_m2"), (F.col("_m0") + F.col("_m1")) / 2)
           .otherwise((F.col("_m0") + F.col("_m2")) / 2))
    loo = F.when(F.col("_n") < 2, F.lit(None).cast("double")).when(F.col("_n") % 2 == 0, even).otherwise(odd)
    return df.join(mid, keys, "left").withColumn(
        out, F.when(v.isNotNull(), loo)).withColumn(
        "n_others", F.coalesce(F.col("_n"), F.lit(0)) - F.when(v.isNotNull(), 1).otherwise(0)
    ).drop("_n", "_m0", "_m1", "_m2")
