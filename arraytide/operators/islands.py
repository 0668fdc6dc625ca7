"""Contiguous runs, gaps and unions of intervals, block by block."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import BLK, block_of, carry_in

RUN_BLOCK = 86_400


def runs(df: DataFrame, keys: list[str], pos: str, flag: Column | None = None, min_len: int = 1,
         block: int = RUN_BLOCK) -> DataFrame:
    """(keys, run_start, run_end, run_len): contiguous positions on which `flag` holds, one row per position.

    Runs are found inside each block; only those touching a block edge, at most two per block, meet in the
    per-key window that joins them up.
    """
    d = df if flag is None else df.where(flag)
    d = d.select(*keys, F.col(pos).cast("bigint").alias(pos)).withColumn(BLK, block_of(pos, block))
    w = Window.partitionBy(*keys, BLK).orderBy(pos)
    local = (d.withColumn("_g", F.col(pos) - F.row_number().over(w)).groupBy(*keys, BLK, "_g")
             .agg(F.min(pos).alias("run_start"), F.max(pos).alias("run_end")))
    edge = ((F.col("run_start") == F.col(BLK) * block)
            | (F.col("run_end") == F.col(BLK) * block + (block - 1)))
    # runs at a block edge meet per key, the others stay in windows of their own block
    local = local.withColumn("_e", edge).withColumn("_p", F.when(~F.col("_e"), F.col(BLK)))
    over = Window.partitionBy(*keys, "_p").orderBy("run_start")
    fresh = F.coalesce((F.col("run_start") != F.lag("run_end").over(over) + 1).cast("int"), F.lit(1))
    out = (local.withColumn("_f", fresh).withColumn("_id", F.sum("_f").over(over))
           .groupBy(*keys, "_p", "_id").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))
           .drop("_p", "_id").withColumn("run_len", F.col("run_end") - F.col("run_start") + 1))
    return out.where(F.col("run_len") >= min_len) if min_len > 1 else out


def gaps(df: DataFrame, keys: list[str], pos: str, present: Column | None = None, block: int = RUN_BLOCK) -> DataFrame:
    """The runs of missing positions between a record's own first and last recorded position.

    Made from the runs of what is there, so the dense axis is never built.
    """
    r = runs(df, keys, pos, present, block=block).withColumn(BLK, block_of("run_start", block))
    # the run after the last one of a block is the first one of the next block that has any
    first = r.groupBy(*keys, BLK).agg(F.min("run_start").alias("_f"))
    first = first.select(*keys, BLK, F.lead("_f").over(Window.partitionBy(*keys).orderBy(BLK)).alias("_later"))
    nxt = F.coalesce(F.lead("run_start").over(Window.partitionBy(*keys, BLK).orderBy("run_start")), F.col("_later"))
    return (r.join(first, [*keys, BLK]).withColumn("_next", nxt).where(F.col("_next").isNotNull())
            .select(*keys, (F.col("run_end") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"),
                    (F.col("_next") - F.col("run_end") - 1).alias("gap_len")))


def gap_stats(df: DataFrame, keys: list[str], pos: str, present: Column | None = None,
              block: int = RUN_BLOCK) -> DataFrame:
    """Missing fraction, number of gaps and the longest gap of each record."""
    d = df if present is None else df.where(present)
    ext = d.groupBy(*keys).agg(F.min(pos).alias("_a"), F.max(pos).alias("_z"), F.countDistinct(pos).alias("n_present"))
    g = gaps(d, keys, pos, block=block).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"), F.max("gap_len").alias("longest_gap"))
    n = F.col("_z") - F.col("_a") + 1
    return (ext.join(g, keys, "left")
            .select(*keys, n.alias("n"), (1 - F.col("n_present") / n).alias("nan_fraction"),
                    F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"),
                    F.coalesce("longest_gap", F.lit(0)).alias("longest_gap")))


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, block: int = RUN_BLOCK,
                    extra: list[Column] | None = None) -> DataFrame:
    """The union of intervals per key: overlapping or touching ones become one row.

    Equal starts collapse first. The running maximum of the ends then crosses block edges as one carried number
    per block, and the members of an island are aggregated, never listed. `extra` adds aggregates over the
    original rows of each island.
    """
    d = df.withColumn("_s", F.col(start).cast("bigint")).withColumn("_e", F.col(end).cast("bigint"))
    one = d.groupBy(*keys, "_s").agg(F.max("_e").alias("_e")).withColumn(BLK, block_of("_s", block))
    one = carry_in(one, keys, "_s", {"_mx": F.max("_e")}, {"_mx": "max"})
    inside = Window.partitionBy(*keys, BLK).orderBy("_s")
    reach = F.greatest(F.col("_in__mx"), F.max("_e").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    one = one.withColumn("_reach", reach).withColumn(
        "_first", F.when(F.col("_reach").isNull() | (F.col("_s") > F.col("_reach")), F.col("_s"))).drop("_in__mx")
    one = carry_in(one, keys, "_s", {"_fs": F.max("_first")}, {"_fs": "max"})
    island = F.coalesce(F.max("_first").over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.col("_in__fs"))
    one = one.withColumn("_isl", island)
    if extra:
        tag = one.select(*keys, "_s", "_isl")
        full = d.join(tag, [*keys, "_s"])
    else:
        full = one
    return (full.groupBy(*keys, "_isl").agg(F.max("_e").alias("_end"), *(extra or []))
            .withColumnRenamed("_isl", start).withColumnRenamed("_end", end))


def island_of(df: DataFrame, keys: list[str], start: str, end: str, block: int = RUN_BLOCK) -> DataFrame:
    """Every interval with `island`, the start of the merged interval it belongs to."""
    d = df.withColumn("_s", F.col(start).cast("bigint")).withColumn("_e", F.col(end).cast("bigint"))
    m = merge_intervals(d, keys, "_s", "_e", block).withColumnRenamed("_s", "island").select(*keys, "island")
    # the island an interval lies in is the last island start at or before its own start
    pts = (d.select(*keys, F.col("_s").alias("_p")).distinct()
           .join(m.select(*keys, F.col("island").alias("_p"), F.col("island").alias("_is")), [*keys, "_p"], "left")
           .withColumn(BLK, block_of("_p", block)))
    pts = carry_in(pts, keys, "_p", {"_li": F.max("_is")}, {"_li": "max"})
    w = Window.partitionBy(*keys, BLK).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    pts = pts.select(*keys, F.col("_p").alias("_s"),
                     F.coalesce(F.max("_is").over(w), F.col("_in__li")).alias("island"))
    return d.join(pts, [*keys, "_s"]).drop("_s", "_e")


def flagged_intervals(chunks: DataFrame, keys: list[str], slot: str, flag: Column, chunk: int = 1,
                      merge_gap: int = 0, block: int = RUN_BLOCK) -> DataFrame:
    """Flagged chunks as [t_start, t_end): adjacent chunks always merge, gaps shorter than `merge_gap` too."""
    r = runs(chunks, keys, slot, flag, block=block)
    r = r.select(*keys, (F.col("run_start") * chunk).alias("t_start"),
                 ((F.col("run_end") + 1) * chunk).alias("t_end"))
    if merge_gap <= 0:
        return r
    grown = r.withColumn("_te", F.col("t_end") + F.lit(merge_gap - 1))
    m = merge_intervals(grown, keys, "t_start", "_te", block * chunk)
    return m.withColumn("t_end", F.col("_te") - F.lit(merge_gap - 1)).drop("_te")


def floor_dropped(kept: DataFrame, keys: list[str], pos: str, min_len: int, n: str | None = None,
                  block: int = RUN_BLOCK) -> DataFrame:
    """The share of the record the mask keeps and the run floor then throws away."""
    r = runs(kept, keys, pos, block=block)
    return r.groupBy(*keys).agg(
        F.sum("run_len").alias("kept"),
        F.sum(F.when(F.col("run_len") < min_len, F.col("run_len")).otherwise(0)).alias("dropped"),
        F.count_if(F.col("run_len") >= min_len).alias("n_runs"))
