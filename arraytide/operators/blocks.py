"""Windows over one long series, split into blocks so that no series has to fit one task.

A record of one station can hold a third of all rows, so `Window.partitionBy(station)` is not a plan that
scales. Every sequence operator here works on (key, block) instead, a block being a fixed run of axis
positions, and the three ways information crosses a block edge are the three helpers below:

    halo      a frame of bounded reach: the few rows near an edge are copied into the neighbouring block
    carry     an unbounded reach backwards: one summary row per block is scanned, never the samples
    rank      a running count: per-block counts are scanned and added to the rank inside the block

The summaries hold one row per (key, block), so the only window left over a whole key is over its blocks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLK = "_blk"


def block_of(pos: Column | str, block: int) -> Column:
    """floor(pos / block) in integer arithmetic, right for negative positions."""
    p = F.col(pos) if isinstance(pos, str) else pos
    p = p.cast("bigint")
    return ((p - F.pmod(p, F.lit(int(block)))) / F.lit(int(block))).cast("bigint")


def with_halo(df: DataFrame, pos: str, block: int, before: int, after: int) -> DataFrame:
    """Rows tagged with every block whose frames can reach them; at most the edge rows are copied."""
    lo = block_of(F.col(pos) - F.lit(int(after)), block)
    hi = block_of(F.col(pos) + F.lit(int(before)), block)
    return df.withColumn(BLK, F.explode(F.sequence(lo, hi)))


def trim_halo(df: DataFrame, pos: str, block: int) -> DataFrame:
    """Drop the copies again: a row belongs to the block its own position falls in."""
    return df.where(block_of(pos, block) == F.col(BLK)).drop(BLK)


def block_window(keys: list[str], pos: str):
    return Window.partitionBy(*keys, BLK).orderBy(pos)


def same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def carry_in(df: DataFrame, keys: list[str], pos: str, aggs: dict[str, Column], scans: dict[str, str]) -> DataFrame:
    """Join onto every row what the earlier blocks of its key summarise to.

    `aggs` gives the per-block summary columns and `scans` how each is scanned over the earlier blocks:
    'last' (last non-null), 'max' or 'sum'. `df` carries the block column already.
    """
    per = df.groupBy(*keys, BLK).agg(*[a.alias(n) for n, a in aggs.items()])
    earlier = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    made = []
    for name, how in scans.items():
        if how == "last":
            c = F.last(F.col(name), ignorenulls=True).over(earlier)
        elif how == "max":
            c = F.max(name).over(earlier)
        else:
            c = F.coalesce(F.sum(name).over(earlier), F.lit(0))
        made.append(c.alias("_in_" + name))
    per = per.select(*keys, BLK, *made)
    return df.join(per, [*keys, BLK], "left")


def neighbours(df: DataFrame, keys: list[str], pos: str, value: str, block: int, strict: bool = False) -> DataFrame:
    """Every row with the nearest non-null value at or before it and at or after it, however far away.

    Columns prev_pos, prev_val, next_pos, next_val; on a row that holds a value both are that row, unless
    `strict`, which leaves the row itself out.
    """
    d = df.withColumn(BLK, block_of(pos, block)).withColumn(
        "_pv", F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
    per = d.groupBy(*keys, BLK).agg(F.max("_pv").alias("_l"), F.min("_pv").alias("_f"))
    by = Window.partitionBy(*keys).orderBy(BLK)
    per = per.select(*keys, BLK, F.last("_l", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                     F.first("_f", ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    w = Window.partitionBy(*keys, BLK).orderBy(pos)
    d = d.join(per, [*keys, BLK], "left")
    back = F.coalesce(F.last("_pv", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1 if strict else 0)), F.col("_before"))
    ahead = F.coalesce(F.first("_pv", ignorenulls=True).over(w.rowsBetween(1 if strict else 0, Window.unboundedFollowing)), F.col("_after"))
    return (d.withColumn("_b", back).withColumn("_a", ahead)
            .withColumns({"prev_pos": F.col("_b.p"), "prev_val": F.col("_b.v"), "next_pos": F.col("_a.p"), "next_val": F.col("_a.v")})
            .drop("_pv", "_before", "_after", "_b", "_a", BLK))


def ranked(df: DataFrame, bucket: Column, order: list[Column], name: str = "rank") -> DataFrame:
    """A global 1-based row number without a global sort: rank inside a bucket plus the earlier buckets' counts.

    `bucket` has to be a monotone coarse form of the order, so buckets are whole runs of it. The scan over the
    buckets is one small window.
    """
    d = df.withColumn("_bk", bucket)
    counts = d.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy(F.lit(0)).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_bk", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_bk").orderBy(*order)
    return (d.join(offs, "_bk").withColumn(name, (F.row_number().over(w) + F.col("_off")).cast("bigint"))
            .drop("_bk", "_off"))
