"""Who recorded when: the deployment register from spans (station, start, end) in unix seconds."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import geo
from .blocks import block_of, ranked
from .islands import island_of

DAY = 86_400
HALF_DAYS = 7
# blocks of days go up to 4096 days
TOP_LEVEL = 12


def active_per_day(spans: DataFrame, start: str = "t_start", end: str = "t_end") -> DataFrame:
    """Stations recording on every calendar day of the register.

    Each span adds one on its first day and takes it off after its last, so a span costs two rows whatever its
    length; the running sum is over days.
    """
    d0, d1 = block_of(start, DAY), block_of(end, DAY)
    steps = spans.select(F.explode(F.array(F.struct(d0.alias("day"), F.lit(1).alias("s")),
                                           F.struct((d1 + 1).alias("day"), F.lit(-1).alias("s")))).alias("e"))
    steps = steps.groupBy("e.day").agg(F.sum("e.s").alias("s"))
    ends = steps.agg(F.min("day").alias("a"), F.max("day").alias("z"))
    days = ends.where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", F.col("z") - 1)).alias("day"))
    w = Window.partitionBy(F.lit(0)).orderBy("day")
    return days.join(steps, "day", "left").select("day", F.sum(F.coalesce("s", F.lit(0))).over(w).alias("active"))


def peaks(active: DataFrame, min_sites: int = 2) -> DataFrame:
    """The first day of every plateau higher than the days either side of it. One row per day comes in."""
    w = Window.partitionBy(F.lit(0)).orderBy("day")
    steps = active.withColumn("_p", F.lag("active").over(w)).where(
        F.col("_p").isNull() | (F.col("_p") != F.col("active")))
    nxt = F.coalesce(F.lead("active").over(w), F.lit(-1))
    left = F.coalesce(F.col("_p"), F.lit(-1))
    return (steps.withColumn("_x", nxt).where((F.col("active") >= min_sites) & (F.col("active") > left)
                                              & (F.col("active") > F.col("_x"))).select("day", "active"))


def _covered(spans: DataFrame, half_days: int, start: str, end: str) -> DataFrame:
    """Spans by the blocks (level, block) of 2^level days that together are the days whose window of half_days either side they cover.

    Every day of a span lies in exactly one of its blocks. Below the top level a range takes its odd first and its even last block and leaves
    the rest to the next level, so a span of any survey is some twenty rows and not one per day.
    """
    c = F.col
    first, last = F.ceil((c(start) + half_days * DAY) / DAY).cast("bigint"), block_of(c(end) - half_days * DAY, DAY)
    d = spans.withColumns({"_first": first, "_last": last}).where("_first <= _last").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))))
    shift = lambda x: F.call_function("shiftright", x, c("level"))
    d = d.withColumns({"_lo": -shift(-c("_first")), "_end": shift(c("_last") + 1)}).where("_lo < _end")
    sides = F.array_compact(F.array(F.when(F.pmod("_lo", F.lit(2)) == 1, c("_lo")), F.when(F.pmod("_end", F.lit(2)) == 1, c("_end") - 1)))
    d = d.withColumn("block", F.explode(F.when(c("level") < TOP_LEVEL, sides).otherwise(F.sequence("_lo", c("_end") - 1))))
    return d.select(*spans.columns, "level", "block")


def _blocks_of_days(peak_days: DataFrame) -> DataFrame:
    """(day, level, block): the block of every level that holds the day."""
    d = peak_days.select("day", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))).alias("level"))
    return d.withColumn("block", F.call_function("shiftright", F.col("day"), F.col("level")))


def core_members(spans: DataFrame, peak_days: DataFrame, half_days: int = HALF_DAYS, site: str = "site",
                 start: str = "t_start", end: str = "t_end") -> DataFrame:
    """(day, site, ...) of the stations that cover the window of half_days either side of each peak.

    A station covers a peak exactly when the peak's day lies in a range of days of its span. Range and day meet in the one block of days
    that holds the day and is part of the range, so the range join is an equi-join and only members are made.
    """
    d = _covered(spans, half_days, start, end)
    return d.join(_blocks_of_days(peak_days), ["level", "block"]).select("day", *spans.columns)


def core_groups(spans: DataFrame, peak_days: DataFrame, half_days: int = HALF_DAYS, by: str = "instrument",
                start: str = "t_start", end: str = "t_end") -> DataFrame:
    """Per peak and instrument: how many stations cover it and the window they all share.

    Stations are counted per block of days before they meet a peak, so what is shuffled follows the calendar and not the stations.
    """
    d = _covered(spans.select(by, start, end), half_days, start, end)
    d = d.groupBy("level", "block", by).agg(F.count(F.lit(1)).alias("_n"), F.max(start).alias("_a"), F.min(end).alias("_z"))
    m = d.join(_blocks_of_days(peak_days), ["level", "block"])
    g = m.groupBy("day", by).agg(F.sum("_n").alias("n_core"), F.max("_a").alias("common_start"), F.min("_z").alias("common_end"))
    return g.withColumn("days", block_of(F.col("common_end") - F.col("common_start"), DAY))


def named_overlaps(pairs: DataFrame, spans: DataFrame, site: str = "site", start: str = "t_start", end: str = "t_end") -> DataFrame:
    """Days of overlap of the named pairs (a, b) that overlap: no other pair is made."""
    s = lambda n: spans.select(F.col(site).alias(n), F.col(start).alias(n + "0"), F.col(end).alias(n + "1"))
    j = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(s("a"), "a").join(s("b"), "b")
    sec = F.least("a1", "b1") - F.greatest("a0", "b0")
    return j.where(sec > 0).select("a", "b", F.round(sec / float(DAY), 2).alias("overlap_days"))


def overlap_pairs(spans: DataFrame, site: str = "site", start: str = "t_start", end: str = "t_end",
                  cell_days: int = 64) -> DataFrame:
    """Days of overlap of every pair of stations that overlap, rounded to 2 decimals.

    Spans meet on the time cells they share and a pair is emitted in its first shared cell only, so pairs that
    never overlap are not made. The result is a table over stations, of which a survey has hundreds.
    """
    cell = cell_days * DAY
    s = spans.select(F.col(site).alias("a"), F.col(start).alias("a0"), F.col(end).alias("a1"))
    s = s.withColumn("c", F.explode(F.sequence(block_of("a0", cell), block_of("a1", cell))))
    r = s.select(F.col("a").alias("b"), F.col("a0").alias("b0"), F.col("a1").alias("b1"), "c")
    j = s.join(r, "c").where((F.col("a") < F.col("b")) & (F.col("c") == F.greatest(block_of("a0", cell), block_of("b0", cell))))
    sec = F.least("a1", "b1") - F.greatest("a0", "b0")
    return j.where(sec > 0).select("a", "b", F.round(sec / float(DAY), 2).alias("overlap_days"))


def _least_seconds(min_days: float) -> int:
    """The fewest seconds of overlap whose days, rounded to 2 decimals, reach the floor."""
    k = max(0, math.floor((min_days - 0.006) * DAY))
    while round(k / DAY, 2) < min_days:
        k += 1
    return k


def overlap_groups(spans: DataFrame, min_overlap_days: float, site: str = "site", start: str = "t_start",
                   end: str = "t_end") -> tuple[DataFrame, DataFrame]:
    """(one row per group, one row per station with its group): components of 'two stations overlap enough'.

    Two spans share at least d exactly when the spans shortened by d still meet, so the components of the graph
    are the islands of the shortened spans: one sweep in place of a pair table and a label-propagation loop. A
    span shorter than d overlaps nothing enough and is a group of its own. `common_days` is 0 where a group is
    held together by a chain and shares no window.
    """
    need = _least_seconds(min_overlap_days)
    long = (F.col(end) - F.col(start)) >= need
    d = spans.withColumn("_all", F.lit(0))
    tied = island_of(d.where(long).withColumn("_cut", F.col(end) - need), ["_all"], start, "_cut", block=64 * DAY)
    tied = tied.select(site, start, end, F.concat(F.lit("g"), F.col("island")).alias("_g"))
    single = d.where(~long).select(site, start, end, F.concat(F.lit("s"), F.col(site)).alias("_g"))
    m = tied.unionByName(single)
    g = m.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("first_start"), F.min_by(site, F.struct(start, site)).alias("first_site"),
                            F.max(start).alias("_cs"), F.min(end).alias("_ce"))
    g = ranked(g, block_of("first_start", 64 * DAY), [F.col("first_start"), F.col("first_site")], "_no")
    has = F.col("_ce") > F.col("_cs")
    name = F.concat(F.lit("G"), F.lpad(F.col("_no").cast("string"), 2, "0"))
    name = F.when(F.col("_no") > 99, F.concat(F.lit("G"), F.col("_no").cast("string"))).otherwise(name)
    g = g.withColumn("group", name)
    groups = g.select("group", "n", F.when(has, F.col("_cs")).alias("common_start"), F.when(has, F.col("_ce")).alias("common_end"),
                      F.when(has, F.round((F.col("_ce") - F.col("_cs")) / float(DAY), 2)).otherwise(F.lit(0.0)).alias("common_days"))
    members = m.join(g.select("_g", "group"), "_g").select("group", site, start, end)
    return groups, members


def remote_audit(decisions: DataFrame, members: DataFrame, pairs: DataFrame, site: str = "site",
                 remote: str = "remote") -> DataFrame:
    """Each station's chosen remote: in its own overlap group and with some overlap, or the row says which fails."""
    grp = members.select(F.col(site), F.col("group"))
    rgrp = members.select(F.col(site).alias(remote), F.col("group").alias("remote_group"))
    lo, hi = F.least(site, remote), F.greatest(site, remote)
    d = decisions.join(grp, site, "left").join(rgrp, remote, "left").withColumns({"a": lo, "b": hi})
    d = d.join(pairs, ["a", "b"], "left")
    same = F.coalesce(F.col("group") == F.col("remote_group"), F.lit(False))
    ov = F.coalesce("overlap_days", F.lit(0.0))
    return d.select(site, remote, ov.alias("overlap_days"), F.coalesce("group", F.lit("")).alias("group"),
                    F.coalesce("remote_group", F.lit("")).alias("remote_group"), (same & (ov > 0)).alias("ok"))


def regression_compare(ours: DataFrame, theirs: DataFrame, site: str = "site", tol_m: float = 20.0, tol_h: float = 1.0,
                       containment: bool = False) -> DataFrame:
    """Our register against an earlier one: metres and hours apart, and which criterion each station fails.

    `containment` asks only that our span holds theirs within the tolerance.
    """
    t = theirs.select(site, *[F.col(c).alias(c + "_ref") for c in ("lat", "lon", "t_start", "t_end")]).withColumn("_r", F.lit(1))
    j = ours.withColumn("_l", F.lit(1)).join(t, site, "full_outer")
    m = geo.distance_km(F.col("lat"), F.col("lon"), F.col("lat_ref"), F.col("lon_ref")) * 1000
    ds, de = (F.col("t_start") - F.col("t_start_ref")) / 3600.0, (F.col("t_end") - F.col("t_end_ref")) / 3600.0
    bad = (ds > tol_h) | (de < -tol_h) if containment else (F.abs(ds) > tol_h) | (F.abs(de) > tol_h)
    side = F.when(F.col("_l").isNull(), "reference only").when(F.col("_r").isNull(), "register only").otherwise("both")
    call = (F.when(side != "both", F.lit("one table only")).when(m > tol_m, "position").when(bad, "span").otherwise("ok"))
    return j.select(site, side.alias("side"), m.alias("separation_m"), ds.alias("start_diff_h"), de.alias("end_diff_h"), call.alias("call"))


def _meet(stations: DataFrame, points: DataFrame, site: str, cell: int) -> DataFrame:
    """Stations with the points of the 3 x 3 cells around them, cells wrapping at the date line."""
    n = 360 // cell
    fl = lambda c: F.floor(F.col(c) / cell).cast("int")
    around = F.array_distinct(F.flatten(F.array(*[F.array(*[
        F.struct((fl("lat") + a).alias("y"), F.pmod(fl("lon") + b, F.lit(n)).alias("x")) for b in (-1, 0, 1)])
        for a in (-1, 0, 1)])))
    s = stations.withColumn("_c", F.explode(around))
    p = points.withColumn("_c", F.struct(fl("_plat").alias("y"), F.pmod(fl("_plon"), F.lit(n)).alias("x")))
    return s.join(p, "_c").drop("_c")


def nearest(stations: DataFrame, points: DataFrame, k: int, site: str = "site", name: str = "name",
            levels: tuple[int, ...] = (1, 8, 180)) -> DataFrame:
    """The k nearest points of each station, nearest first, ties by name; exact.

    Stations meet the points of their own and the neighbouring cells. A station is done where its k-th distance
    is no longer than the way out of those cells; the rest go on to the next, coarser cells, the last of which
    span the globe. Only stations with fewer than k points near them ever reach that level.
    """
    p = points.select(F.col(site).alias(name), F.col("lat").alias("_plat"), F.col("lon").alias("_plon"))
    todo, done = stations.select(site, "lat", "lon"), None
    w = Window.partitionBy(site).orderBy(F.round("km", 9), name)
    for level in levels:
        j = _meet(todo, p, site, level).where(F.col(site) != F.col(name)).withColumn(
            "km", geo.distance_km(F.col("lat"), F.col("lon"), F.col("_plat"), F.col("_plon")))
        j = j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        got = j.select(site, name, "km", "rank",
                       geo.bearing_deg(F.col("lat"), F.col("lon"), F.col("_plat"), F.col("_plon")).alias("bearing"), "lat")
        if level != levels[-1]:
            out = F.asin(F.sin(F.radians(F.lit(float(min(level, 90))))) * F.cos(F.radians("lat"))) * geo.EARTH_RADIUS_KM
            sure = (got.groupBy(site).agg(F.count(F.lit(1)).alias("_n"), F.max("km").alias("_far"), F.first("lat").alias("lat"))
                    .where((F.col("_n") == k) & (F.col("_far") <= out)).select(site))
            got, todo = got.join(sure, site, "left_semi"), todo.join(sure, site, "left_anti")
        got = got.drop("lat")
        done = got if done is None else done.unionByName(got)
    return done
