"""The tail scan judged against the rest of the array: events, baselines, the clean pool, fleet weights.

Input is the long tail scan (site, slot, chan, power): one band power per station, 600 s slot and channel, NULL
where the chunk is not whole.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import islands
from .quantiles import group_percentiles, others_median

# fixed thresholds of the pool
OWN_RATIO = 100.0
FLEET_EXCESS = 10.0
MIN_FLEET = 3
EVENT_FRAC_MAX = 0.02
BASELINE_MAX = 10.0
E_BURST_RATIO = 100.0


def slot_of(seconds, chunk_s: float):
    """Grid slot by floor, snapping only within 1e-6 of a whole number of chunks."""
    q = seconds / F.lit(float(chunk_s))
    r = F.bround(q, 0)
    return F.when(F.abs(q - r) <= 1e-6, r).otherwise(F.floor(q)).cast("bigint")


def summary(tails: DataFrame) -> DataFrame:
    """Per station and channel: the chunks, the median, the worst ratio to it and the missing fraction."""
    med = group_percentiles(tails, ["site", "chan"], "power", {"median": 0.5})
    g = tails.groupBy("site", "chan").agg(F.count(F.lit(1)).alias("chunks"), F.max("power").alias("_mx"),
                                          F.avg(F.col("power").isNull().cast("double")).alias("nan_frac"))
    return g.join(med, ["site", "chan"], "left").select(
        "site", "chan", "chunks", "median", F.when(F.col("median") > 0, F.col("_mx") / F.col("median")).alias("max_ratio"),
        "nan_frac")


def event_flags(tails: DataFrame, channels: list[str], own_ratio: float = OWN_RATIO, fleet_excess: float = FLEET_EXCESS,
                min_fleet: int = MIN_FLEET) -> DataFrame:
    """(site, slot, bad) for every scanned chunk.

    A chunk is an event where its power is far above the station's own median on a channel and either too few
    other stations recorded then, or it also stands far above the median of the others. With fewer than
    `min_fleet` other stations scanned at all nothing is flagged.
    """
    t = tails.where(F.col("chan").isin(*channels))
    t = t.withColumn("_lg", F.when(F.col("power") > 0, F.log10("power")))
    own = group_percentiles(t, ["site", "chan"], "power", {"_own": 0.5})
    t = others_median(t, ["slot", "chan"], "_lg", "_fl")
    t = t.join(own, ["site", "chan"], "left")
    loud = (F.col("_own") > 0) & (F.col("power") > F.lit(own_ratio) * F.col("_own"))
    lonely = F.col("n_others") < min_fleet
    excess = F.col("power") > F.lit(fleet_excess) * F.pow(F.lit(10.0), F.col("_fl"))
    hit = F.coalesce(loud & (lonely | F.coalesce(excess, F.lit(False))), F.lit(False))
    per = t.groupBy("site", "slot").agg(F.max(hit).alias("_bad"))
    others = t.select("site").distinct().agg((F.count(F.lit(1)) - 1).alias("n")).scalar()
    return per.select("site", "slot", (F.col("_bad") & (others >= min_fleet)).alias("bad"))


def site_events(flags: DataFrame, chunk_s: int = 600, merge_gap_s: int = 0, block: int = islands.RUN_BLOCK) -> DataFrame:
    """Flagged chunks as merged intervals of unix seconds."""
    return islands.flagged_intervals(flags, ["site"], "slot", F.col("bad"), chunk_s, merge_gap_s, block)


def e_bursts(tails: DataFrame, channels: list[str], ratio: float = E_BURST_RATIO, chunk_s: int = 600,
             block: int = islands.RUN_BLOCK) -> DataFrame:
    """Intervals in which either electric line exceeds `ratio` times its own median; no fleet test."""
    t = tails.where(F.col("chan").isin(*channels))
    own = group_percentiles(t, ["site", "chan"], "power", {"_own": 0.5})
    hit = (F.col("_own") > 0) & (F.col("power") > F.lit(ratio) * F.col("_own"))
    per = t.join(own, ["site", "chan"]).groupBy("site", "slot").agg(F.max(F.coalesce(hit, F.lit(False))).alias("bad"))
    return site_events(per, chunk_s, 0, block)


def baselines(tails: DataFrame, channels: list[str]) -> DataFrame:
    """Each station's baseline, the larger of its channel medians, over the median baseline of the survey.

    The larger and not the mean, so a dead channel cannot hide behind a sound one's quiet.
    """
    own = (group_percentiles(tails.where(F.col("chan").isin(*channels)), ["site", "chan"], "power", {"_m": 0.5})
           .where(F.col("_m") > 0).groupBy("site").agg(F.max("_m").alias("level")))
    # one row per station comes in, and one number goes out as a scalar subquery
    ref = own.agg(F.median("level").alias("_ref")).scalar()
    return own.withColumn("_ref", ref).select("site", "level", F.when(F.col("_ref") > 0, F.col("level") / F.col("_ref")).alias("baseline"))


def clean_pool(tails: DataFrame, flags: DataFrame, channels: list[str], event_frac_max: float = EVENT_FRAC_MAX,
               baseline_max: float = BASELINE_MAX, min_fleet: int = MIN_FLEET) -> DataFrame:
    """Every station with both numbers of the clean test and the reason it failed, if it did."""
    sites = tails.select("site").distinct()
    frac = flags.groupBy("site").agg(F.avg(F.col("bad").cast("double")).alias("event_frac"))
    base = baselines(tails, channels).select("site", "baseline")
    n = sites.agg((F.count(F.lit(1)) - 1).alias("n")).scalar()
    d = sites.join(frac, "site", "left").join(base, "site", "left").withColumn("_others", n)
    on = F.col("_others") >= min_fleet
    why = F.array_compact(F.array(
        F.when(on & F.col("event_frac").isNull(), "no chunk scored"),
        F.when(on & (F.col("event_frac") > event_frac_max), "event fraction over the ceiling"),
        F.when(F.col("baseline").isNull(), "no baseline"),
        F.when(F.col("baseline") > baseline_max, "baseline over the survey ceiling")))
    return d.select("site", F.when(on, F.col("event_frac")).alias("event_frac"), "baseline", (F.size(why) == 0).alias("clean"),
                    F.array_join(why, "; ").alias("reason"), on.alias("fleet_normalised"))


def fleet_weights(pairs: DataFrame, pool: DataFrame, min_chunks: int = 3) -> DataFrame:
    """Each station's median coherence over its pairs with the pool; NULL with no pair of enough chunks."""
    ends = pairs.where((F.col("chunks") >= min_chunks) & F.col("coh").isNotNull()).select(
        F.explode(F.array("a", "b")).alias("site"), "coh")
    w = group_percentiles(ends, ["site"], "coh", {"weight": 0.5})
    return pool.select("site").join(w, "site", "left").select("site", F.round("weight", 4).alias("weight"))
