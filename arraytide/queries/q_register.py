"""The deployment register and the fleet tests."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import blocks, fleet, register
from .bind import EV, REC, SP, ev, rec, sp, with_
from .registry import query

DAYSEC = 86400

# stations at the nations, positions read off the suppliers' balances
ST = """st AS (SELECT s_nationkey AS site, -20.0 - sum(CAST(round(s_acctbal * 100) AS BIGINT)) / (100000.0 * count(*)) AS lat,
  120.0 + max(CAST(round(s_acctbal * 100) AS BIGINT)) / 100000.0 AS lon FROM supplier GROUP BY 1)"""


def st(t):
    c = F.round(F.col("s_acctbal") * 100).cast("bigint")
    return t.supplier.groupBy(F.col("s_nationkey").cast("bigint").alias("site")).agg(
        (-20.0 - F.sum(c) / (100000.0 * F.count(F.lit(1)))).alias("lat"), (120.0 + F.max(c) / 100000.0).alias("lon"))


def km_sql(a, b):
    return (f"2 * 6371.0088 * asin(sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))"
            f" * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))")


ACT = """act AS (SELECT day, (SELECT count(*) FROM sp WHERE t_start // 86400 <= day AND t_end // 86400 >= day) AS active
  FROM (SELECT unnest(generate_series((SELECT min(t_start // 86400) FROM sp), (SELECT max(t_end // 86400) FROM sp))) AS day))"""
PEAK = """chg AS (SELECT *, lag(active) OVER (ORDER BY day) AS p FROM act QUALIFY p IS NULL OR p <> active),
pk AS (SELECT day, active FROM (SELECT *, lead(active) OVER (ORDER BY day) AS x FROM chg) WHERE active >= 2 AND active > coalesce(p, -1) AND active > coalesce(x, -1))"""


@query("active_per_day", "day:b active:b", "A7", with_(SP, ACT) + "SELECT * FROM act")
def active_per_day(t):
    return register.active_per_day(sp(t))


@query("span_table", "site:b t_start:b t_end:b days:d instrument:s", "A7 S7",
       with_(SP) + "SELECT site, t_start, t_end, (t_end - t_start) / 86400.0 AS days, instrument FROM sp")
def span_table(t):
    return sp(t).withColumn("days", (F.col("t_end") - F.col("t_start")) / 86400.0)


@query("active_peaks", "day:b active:b", "W15", with_(SP, ACT, PEAK) + "SELECT * FROM pk")
def active_peaks(t):
    return register.peaks(register.active_per_day(sp(t)))


@query("core_groups", "day:b instrument:s n_core:b common_start:b common_end:b days:b", "J5", with_(SP, ACT, PEAK) + """SELECT day, instrument, count(*) AS n_core,
  max(t_start) AS common_start, min(t_end) AS common_end, (min(t_end) - max(t_start)) // 86400 AS days FROM pk JOIN sp
  ON t_start <= (day - 7) * 86400 AND t_end >= (day + 7) * 86400 GROUP BY 1, 2""")
def core_groups(t):
    s = sp(t)
    return register.core_groups(s, register.peaks(register.active_per_day(s)))


NSP = """nsp AS (SELECT site * 10 + CAST(hx AS BIGINT) % 10 AS site, min(i) * 86400 AS t_start, max(i) * 86400 AS t_end FROM rec GROUP BY 1)"""


def nsp(t):
    return rec(t).groupBy((F.col("site") * 10 + F.pmod(F.col("hx").cast("bigint"), F.lit(10))).alias("site")).agg(
        (F.min("i") * DAYSEC).alias("t_start"), (F.max("i") * DAYSEC).alias("t_end"))


OVP = """ov AS (SELECT a.site AS a, b.site AS b, round((least(a.t_end, b.t_end) - greatest(a.t_start, b.t_start)) / 86400.0, 2) AS overlap_days
  FROM nsp a JOIN nsp b ON a.site < b.site AND least(a.t_end, b.t_end) > greatest(a.t_start, b.t_start))"""


@query("overlap_matrix", "a:b b:b overlap_days:d", "J3 J9", with_(REC, NSP, OVP) + "SELECT * FROM ov")
def overlap_matrix(t):
    return register.overlap_pairs(nsp(t))


GRP_DAYS = 1700.0
GRP = f"""lng AS (SELECT site, t_start, t_end, t_end - {int(GRP_DAYS) * 86400} AS cut FROM sp WHERE round((t_end - t_start) / 86400.0, 2) >= {GRP_DAYS}),
isl AS (SELECT *, sum(CASE WHEN reach IS NULL OR t_start > reach THEN 1 ELSE 0 END) OVER (ORDER BY t_start, site) AS g FROM
  (SELECT *, max(cut) OVER (ORDER BY t_start, site ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM lng)),
mem AS (SELECT site, t_start, t_end, 'g' || g AS g FROM isl UNION ALL SELECT site, t_start, t_end, 's' || site FROM sp WHERE site NOT IN (SELECT site FROM lng)),
gg AS (SELECT g, count(*) AS n, min(t_start) AS fs, arg_min(site, (t_start, site)) AS f1, max(t_start) AS cs, min(t_end) AS ce FROM mem GROUP BY g),
gn AS (SELECT *, row_number() OVER (ORDER BY fs, f1) AS no FROM gg),
gl AS (SELECT *, CASE WHEN no < 10 THEN 'G0' || no ELSE 'G' || no END AS grp FROM gn)"""


@query("overlap_groups", "group:s n:b common_start:b common_end:b common_days:d", "J4 D13", with_(SP, GRP) + """SELECT grp AS "group", n,
  CASE WHEN ce > cs THEN cs END AS common_start, CASE WHEN ce > cs THEN ce END AS common_end, CASE WHEN ce > cs THEN round((ce - cs) / 86400.0, 2) ELSE 0 END AS common_days FROM gl""")
def overlap_groups(t):
    return register.overlap_groups(sp(t), GRP_DAYS)[0]


@query("overlap_members", "group:s site:b", "J4", with_(SP, GRP) + """SELECT grp AS "group", site FROM mem JOIN gl USING (g)""")
def overlap_members(t):
    return register.overlap_groups(sp(t), GRP_DAYS)[1]


# the same components found the long way, by following pairs: nations' supplier spans are few enough for it
@query("remote_audit", "site:b remote:b overlap_days:d group:s remote_group:s ok:z", "J13", with_(REC, NSP, OVP, """mem AS (SELECT site, CASE WHEN t_end - t_start > 86400 * 2000 THEN 'long' ELSE 'short' END AS g FROM nsp),
dec AS (SELECT site, lead(site, 3) OVER (ORDER BY site) AS remote FROM nsp)""") + """SELECT dec.site, dec.remote, coalesce(overlap_days, 0) AS overlap_days, coalesce(m.g, '') AS "group", coalesce(r.g, '') AS remote_group,
  coalesce(m.g = r.g, false) AND coalesce(overlap_days, 0) > 0 AS ok FROM dec LEFT JOIN mem m ON m.site = dec.site LEFT JOIN mem r ON r.site = dec.remote
  LEFT JOIN ov ON ov.a = least(dec.site, dec.remote) AND ov.b = greatest(dec.site, dec.remote) WHERE dec.remote IS NOT NULL""")
def remote_audit(t):
    s = nsp(t)
    mem = s.select("site", F.when(F.col("t_end") - F.col("t_start") > DAYSEC * 2000, "long").otherwise("short").alias("group"))
    # the station three places on: ranks are taken per bucket of ids and met by an equi-join
    r = blocks.ranked(s.select("site"), F.floor(F.col("site") / 8), [F.col("site")])
    dec = r.select("site", (F.col("rank") + 3).alias("rank")).join(r.select(F.col("site").alias("remote"), "rank"), "rank").select("site", "remote")
    return register.remote_audit(dec, mem, register.named_overlaps(dec.select(F.col("site").alias("a"), F.col("remote").alias("b")), s))


@query("regression_compare", "site:b side:s separation_m:d start_diff_h:d end_diff_h:d call:s", "J12", f"""WITH {SP},
a AS (SELECT site, -20.0 - (site % 50) / 10.0 AS lat, 130.0 AS lon, t_start, t_end FROM sp WHERE site % 7 <> 0),
b AS (SELECT site, -20.0 - (site % 50) / 10.0 + (site % 3) * 0.0001 AS lat, 130.0 AS lon, t_start - 1800 * (site % 4) AS t_start, t_end FROM sp WHERE site % 5 <> 0),
j AS (SELECT coalesce(a.site, b.site) AS site, CASE WHEN a.site IS NULL THEN 'reference only' WHEN b.site IS NULL THEN 'register only' ELSE 'both' END AS side,
  {km_sql('a', 'b')} * 1000 AS separation_m, (a.t_start - b.t_start) / 3600.0 AS start_diff_h, (a.t_end - b.t_end) / 3600.0 AS end_diff_h FROM a FULL JOIN b ON a.site = b.site)
SELECT *, CASE WHEN side <> 'both' THEN 'one table only' WHEN separation_m > 20 THEN 'position' WHEN abs(start_diff_h) > 1 OR abs(end_diff_h) > 1 THEN 'span' ELSE 'ok' END AS call FROM j""")
def regression_compare(t):
    s = sp(t)
    base = -20.0 - (F.col("site") % 50) / 10.0
    a = s.where(F.col("site") % 7 != 0).select("site", base.alias("lat"), F.lit(130.0).alias("lon"), "t_start", "t_end")
    b = s.where(F.col("site") % 5 != 0).select("site", (base + (F.col("site") % 3) * 0.0001).alias("lat"), F.lit(130.0).alias("lon"),
                                               (F.col("t_start") - 1800 * (F.col("site") % 4)).alias("t_start"), "t_end")
    return register.regression_compare(a, b)


@query("nearest_stations", "site:b name:b km:d rank:b bearing:d point:s", "T4 M1", f"""WITH {ST}, j AS (SELECT a.site, b.site AS name, {km_sql('a', 'b')} AS km,
  (degrees(atan2(sin(radians(b.lon) - radians(a.lon)) * cos(radians(b.lat)), cos(radians(a.lat)) * sin(radians(b.lat)) - sin(radians(a.lat)) * cos(radians(b.lat)) * cos(radians(b.lon) - radians(a.lon)))) + 360.0) % 360.0 AS bearing
  FROM st a JOIN st b ON a.site <> b.site)
SELECT *, list_extract(['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'], CAST(round_even(bearing / 22.5, 0) AS BIGINT) % 16 + 1) AS point FROM
(SELECT *, row_number() OVER (PARTITION BY site ORDER BY round(km, 9), name) AS rank FROM j) WHERE rank <= 2""")
def nearest_stations(t):
    s = st(t)
    return register.nearest(s, s, 2).withColumn("point", geo.compass_point(F.col("bearing")))


@query("station_box", "region:b lon_min:d lon_max:d lat_min:d lat_max:d", "M1", f"""WITH {ST}, r AS (SELECT n_regionkey AS region, st.* FROM st JOIN nation ON n_nationkey = site)
SELECT region, min(lon) - greatest(0.08 * (max(lon) - min(lon)), 0.2) AS lon_min, max(lon) + greatest(0.08 * (max(lon) - min(lon)), 0.2) AS lon_max,
  min(lat) - greatest(0.08 * (max(lat) - min(lat)), 0.2) AS lat_min, max(lat) + greatest(0.08 * (max(lat) - min(lat)), 0.2) AS lat_max FROM r GROUP BY region""")
def station_box(t):
    d = st(t).join(t.nation, F.col("site") == F.col("n_nationkey"))
    return d.groupBy(F.col("n_regionkey").alias("region")).agg(*geo.padded_box("lat", "lon"))


# ---------------------------------------------------------------- the tail scan

TL = """tl AS (SELECT site, sec // 21600 AS slot, CASE WHEN etype IN ('view', 'click') THEN 'hx' WHEN etype IN ('error', 'signup') THEN 'hy' ELSE 'ex' END AS chan,
  CASE WHEN sum(cents) > 100 THEN CAST(sum(cents) AS DOUBLE) * sum(cents) END AS power FROM ev GROUP BY 1, 2, 3)"""


def tl(t):
    chan = F.when(F.col("etype").isin("view", "click"), "hx").when(F.col("etype").isin("error", "signup"), "hy").otherwise("ex")
    s = F.sum("cents")
    return ev(t).groupBy("site", F.floor(F.col("sec") / 21600).alias("slot"), chan.alias("chan")).agg(
        F.when(s > 100, s.cast("double") * s).alias("power"))


FLAGS = """med AS (SELECT site, chan, median(power) AS own FROM tl GROUP BY 1, 2),
lo AS (SELECT a.site, a.slot, a.chan, a.power, count(b.power) AS n_others, median(log10(b.power)) AS fl FROM tl a LEFT JOIN tl b
  ON b.slot = a.slot AND b.chan = a.chan AND b.site <> a.site AND b.power IS NOT NULL WHERE a.chan IN ('hx', 'hy') GROUP BY 1, 2, 3, 4),
fl AS (SELECT lo.site, lo.slot, bool_or(coalesce(own > 0 AND power > 20 * own AND (n_others < 3 OR coalesce(power > 10 * pow(10, fl), false)), false)) AS bad
  FROM lo JOIN med ON med.site = lo.site AND med.chan = lo.chan GROUP BY 1, 2)"""


def flags(t):
    return fleet.event_flags(tl(t), ["hx", "hy"], own_ratio=20.0)


@query("tail_summary", "site:b chan:s chunks:b median:d max_ratio:d nan_frac:d", "A8 D11 J22", with_(EV, TL) + """SELECT site, chan, count(*) AS chunks, median(power) AS median,
  CASE WHEN median(power) > 0 THEN max(power) / median(power) END AS max_ratio, avg(CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END) AS nan_frac FROM tl GROUP BY 1, 2""")
def tail_summary(t):
    return fleet.summary(tl(t))


@query("fleet_event_flags", "site:b slot:b bad:z", "A10 J7", with_(EV, TL, FLAGS) + "SELECT * FROM fl")
def fleet_event_flags(t):
    return flags(t)


@query("site_events", "site:b t_start:b t_end:b", "A10 D3", with_(EV, TL, FLAGS) + """SELECT site, min(slot) * 21600 AS t_start, (max(slot) + 1) * 21600 AS t_end FROM
  (SELECT site, slot, slot - row_number() OVER (PARTITION BY site ORDER BY slot) AS g FROM fl WHERE bad) GROUP BY site, g""")
def site_events(t):
    return fleet.site_events(flags(t), 21600, block=16)


@query("e_bursts", "site:b t_start:b t_end:b", "A10", with_(EV, TL, """m AS (SELECT site, chan, median(power) AS own FROM tl WHERE chan = 'ex' GROUP BY 1, 2),
b AS (SELECT tl.site, slot FROM tl JOIN m ON m.site = tl.site AND m.chan = tl.chan WHERE own > 0 AND power > 5 * own)""") + """SELECT site, min(slot) * 21600 AS t_start, (max(slot) + 1) * 21600 AS t_end FROM
  (SELECT site, slot, slot - row_number() OVER (PARTITION BY site ORDER BY slot) AS g FROM b) GROUP BY site, g""")
def e_bursts(t):
    return fleet.e_bursts(tl(t), ["ex"], 5.0, 21600, block=16)


BASE = """bl AS (SELECT site, max(m) AS level FROM (SELECT site, chan, median(power) AS m FROM tl WHERE chan IN ('hx', 'hy') GROUP BY 1, 2) WHERE m > 0 GROUP BY site),
br AS (SELECT site, level, level / (SELECT median(level) FROM bl) AS baseline FROM bl)"""


@query("site_baselines", "site:b level:d baseline:d", "A9", with_(EV, TL, BASE) + "SELECT * FROM br")
def site_baselines(t):
    return fleet.baselines(tl(t), ["hx", "hy"])


@query("clean_pool", "site:b event_frac:d baseline:d clean:z reason:s", "A9", with_(EV, TL, FLAGS, BASE, """ef AS (SELECT site, avg(CASE WHEN bad THEN 1.0 ELSE 0.0 END) AS event_frac FROM fl GROUP BY site)""") + """SELECT site, event_frac, baseline,
  reason = '' AS clean, reason FROM (SELECT s.site, event_frac, baseline, concat_ws('; ', CASE WHEN event_frac IS NULL THEN 'no chunk scored' END, CASE WHEN event_frac > 0.02 THEN 'event fraction over the ceiling' END,
  CASE WHEN baseline IS NULL THEN 'no baseline' END, CASE WHEN baseline > 1.5 THEN 'baseline over the survey ceiling' END) AS reason
  FROM (SELECT DISTINCT site FROM tl) s LEFT JOIN ef ON ef.site = s.site LEFT JOIN br ON br.site = s.site)""")
def clean_pool(t):
    return fleet.clean_pool(tl(t), flags(t), ["hx", "hy"], baseline_max=1.5)


PR = """hxd AS (SELECT site, i, hx FROM rec), pr AS (SELECT a.site AS a, b.site AS b, corr(a.hx, b.hx) AS c, count(*) AS chunks FROM hxd a JOIN hxd b ON a.i = b.i AND a.site < b.site GROUP BY 1, 2)"""


def pr(t):
    d = rec(t).select("site", "i", "hx")
    a, b = d.select(F.col("site").alias("a"), "i", F.col("hx").alias("xa")), d.select(F.col("site").alias("b"), "i", F.col("hx").alias("xb"))
    return a.join(b, "i").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.corr("xa", "xb").alias("c"), F.count(F.lit(1)).alias("chunks"))


@query("fleet_weights", "site:b weight:d", "A11 J10", with_(REC, PR) + """SELECT s.site, round(median(c) FILTER (WHERE chunks >= 600), 4) AS weight FROM (SELECT DISTINCT site FROM rec) s
  LEFT JOIN (SELECT a AS site, c, chunks FROM pr UNION ALL SELECT b, c, chunks FROM pr) p ON p.site = s.site GROUP BY s.site""")
def fleet_weights(t):
    p = pr(t).withColumnRenamed("c", "coh")
    return fleet.fleet_weights(p, rec(t).select("site").distinct(), min_chunks=600)
