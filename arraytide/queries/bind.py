"""How the driver's tables stand in for station records, once in Spark and once as SQL common table expressions.

    events      user -> station, event -> sample, event type -> channel
    lineitem    nation (or region) of the supplier -> station, ship date -> axis position, five daily channels
    orders      customer -> station span; rows of a run ledger
    embeddings  one array-valued signal per row

Amounts with two decimals are summed as integer cents, so both engines start from bit-identical doubles.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import axis, hours

# ---------------------------------------------------------------- events

EV = """ev AS (SELECT user_id AS site, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS sec, event_id,
  event_type AS etype, value, CAST(round(value * 100) AS BIGINT) AS cents,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""


def ev(t) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return t.events.select(F.col("user_id").alias("site"), us.alias("us"),
                           F.floor(us / F.lit(1000000)).alias("sec"), "event_id",
                           F.col("event_type").alias("etype"), "value",
                           F.round(F.col("value") * 100).cast("bigint").alias("cents"),
                           F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# hourly samples of one station: the later event of an hour wins
HS = """hs AS (SELECT site, sec // 3600 AS i, arg_max(value, (us, event_id)) AS v, count(*) AS n_read
  FROM ev GROUP BY 1, 2)"""


def hs(t) -> DataFrame:
    d = ev(t).withColumn("i", F.floor(F.col("sec") / 3600))
    return axis.place(d, ["site"], "i", ["value"], ["us", "event_id"]).withColumnRenamed("value", "v")


# ---------------------------------------------------------------- lineitem as a daily five-channel record

REC = """rec AS MATERIALIZED (SELECT s_nationkey AS site, epoch_us(l_shipdate) // 86400000000 AS i,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS hx, CAST(sum(l_linenumber) AS DOUBLE) AS hy,
  CAST(count(*) AS DOUBLE) AS hz, sum(CAST(round(l_discount * 100) AS BIGINT)) / 100.0 AS ex,
  sum(CAST(round(l_tax * 100) AS BIGINT)) / 100.0 AS ey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""

DAX = """dax AS MATERIALIZED (SELECT b.site, b.i, r.hx, r.hy, r.hz, r.ex, r.ey FROM
  (SELECT site, unnest(generate_series(min(i), max(i))) AS i FROM rec GROUP BY site) b
  LEFT JOIN rec r ON r.site = b.site AND r.i = b.i)"""


# the regions as stations: enough rows a day that whole segments exist at every scale; every 97th day is out of service
RGN = """rgn AS MATERIALIZED (SELECT n_regionkey AS site, i, sum(hx) AS hx, sum(hy) AS hy, sum(hz) AS hz, CAST(round(sum(ex) * 100) AS BIGINT) / 100.0 AS ex,
  CAST(round(sum(ey) * 100) AS BIGINT) / 100.0 AS ey FROM rec JOIN nation ON n_nationkey = rec.site WHERE i % 97 <> 13 GROUP BY 1, 2)"""

RAX = """rax AS MATERIALIZED (SELECT b.site, b.i, r.hx, r.hy, r.hz, r.ex, r.ey FROM
  (SELECT site, unnest(generate_series(min(i), max(i))) AS i FROM rgn GROUP BY site) b LEFT JOIN rgn r ON r.site = b.site AND r.i = b.i)"""


# every nation and every region is a station, on every day: a region's site is 100 more than its key
FLEET = """fleet AS (SELECT site, i, hx, hy, hz, ex, ey FROM rec UNION ALL SELECT 100 + n_regionkey AS site, i, sum(hx) AS hx, sum(hy) AS hy, sum(hz) AS hz,
  CAST(round(sum(ex) * 100) AS BIGINT) / 100.0 AS ex, CAST(round(sum(ey) * 100) AS BIGINT) / 100.0 AS ey FROM rec JOIN nation ON n_nationkey = rec.site GROUP BY 1, 2),
rax AS MATERIALIZED (SELECT b.site, b.i, r.hx, r.hy, r.hz, r.ex, r.ey FROM
  (SELECT site, unnest(generate_series(min(i), max(i))) AS i FROM fleet GROUP BY site) b LEFT JOIN fleet r ON r.site = b.site AND r.i = b.i)"""


def day_no(c):
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")


def rec(t) -> DataFrame:
    """The station of a row is looked up first, so that rows merge per station and day before they are shuffled."""
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("bigint")) / 100.0
    li = t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return li.groupBy(F.col("s_nationkey").cast("bigint").alias("site"), day_no("l_shipdate").alias("i")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("hx"), F.sum("l_linenumber").cast("double").alias("hy"),
        F.count(F.lit(1)).cast("double").alias("hz"), cents("l_discount").alias("ex"), cents("l_tax").alias("ey"))


CH = ["hx", "hy", "hz", "ex", "ey"]
DAY_BLOCK = 512


def dax(t) -> DataFrame:
    """The daily record on its dense axis, gaps as NULL."""
    return axis.densify(rec(t), ["site"], "i", CH, block=DAY_BLOCK)


def rgn(t) -> DataFrame:
    d = rec(t).where(F.col("i") % 97 != 13).join(t.nation.select(F.col("n_nationkey").cast("bigint").alias("site"), F.col("n_regionkey").cast("bigint").alias("region")), "site")
    cents = lambda c: F.round(F.sum(c) * 100).cast("bigint") / 100.0
    return d.groupBy(F.col("region").alias("site"), "i").agg(F.sum("hx").alias("hx"), F.sum("hy").alias("hy"), F.sum("hz").alias("hz"), cents("ex").alias("ex"), cents("ey").alias("ey"))


def rax(t) -> DataFrame:
    """The daily record of every region on its dense axis, gaps as NULL."""
    return axis.densify(rgn(t), ["site"], "i", CH, block=DAY_BLOCK)


def fleet(t) -> DataFrame:
    """The daily record of every nation and of every region on its dense axis, gaps as NULL."""
    d = rec(t).join(t.nation.select(F.col("n_nationkey").cast("bigint").alias("site"), (F.col("n_regionkey") + 100).cast("bigint").alias("region")), "site", "left")
    d = d.select(F.explode(F.array_compact(F.array("site", "region"))).alias("site"), "i", *CH)
    cents = lambda c: F.round(F.sum(c) * 100).cast("bigint") / 100.0
    d = d.groupBy("site", "i").agg(*[F.sum(c).alias(c) for c in ("hx", "hy", "hz")], cents("ex").alias("ex"), cents("ey").alias("ey"))
    return axis.densify(d, ["site"], "i", CH, block=DAY_BLOCK)


# ---------------------------------------------------------------- orders as spans and as a ledger

SP = """sp AS (SELECT o_custkey AS site, epoch_us(min(o_orderdate)) // 1000000 AS t_start,
  epoch_us(max(o_orderdate)) // 1000000 AS t_end, c_mktsegment AS instrument
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 4)"""


def sp(t) -> DataFrame:
    o = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return (o.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_custkey").alias("site"), F.unix_seconds(F.col("a").cast("timestamp")).alias("t_start"),
                    F.unix_seconds(F.col("b").cast("timestamp")).alias("t_end"),
                    F.col("c_mktsegment").alias("instrument")))


# ---------------------------------------------------------------- lineitem as response curves

# hour scores of the regions: 32 days make an hour, segments are 16 days long
HOUR, SEGMENT = 32, 16
SCORED = """hb AS (SELECT site, i // 32 AS hour, i % 32 AS p, unnest(['ex', 'hy', 'ey', 'hx']) AS chan, unnest([ex, hy, ey, hx]) AS x FROM rax),
hw AS MATERIALIZED (SELECT site, hour, chan, count(x) AS n FROM hb GROUP BY ALL HAVING count(*) = 32),
hg AS (SELECT hb.site, hb.hour, hb.chan, s, p - 8 * s AS q, x FROM hb JOIN hw USING (site, hour, chan), (SELECT unnest([0, 1, 2]) AS s) WHERE n = 32 AND p BETWEEN 8 * s AND 8 * s + 15),
hm AS (SELECT site, hour, s, chan, avg(x) AS m FROM hg GROUP BY ALL),
hf AS MATERIALIZED (SELECT hg.site, hg.hour, hg.s, hg.chan, f, sum((0.5 - 0.5 * cos(2 * pi() * q / 16.0)) * (x - m) * cos(2 * pi() * f * q / 16.0)) AS re,
  -sum((0.5 - 0.5 * cos(2 * pi() * q / 16.0)) * (x - m) * sin(2 * pi() * f * q / 16.0)) AS im FROM hg JOIN hm USING (site, hour, s, chan), (SELECT unnest(range(1, 7)) AS f) GROUP BY ALL),
hc AS (SELECT a.site, a.hour, a.chan, a.f, (pow(sum(a.re * b.re + a.im * b.im), 2) + pow(sum(a.im * b.re - a.re * b.im), 2)) / nullif(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im), 0) AS g
  FROM hf a JOIN hf b ON a.site = b.site AND a.hour = b.hour AND a.s = b.s AND a.f = b.f AND b.chan = CASE a.chan WHEN 'ex' THEN 'hy' WHEN 'ey' THEN 'hx' END GROUP BY ALL),
hv AS (SELECT site, hour, median(g) FILTER (WHERE chan = 'ex') AS xy, median(g) FILTER (WHERE chan = 'ey') AS yx FROM hc GROUP BY ALL),
sc AS MATERIALIZED (SELECT site, hour AS i, round(xy, 6) AS coh_xy, round(yx, 6) AS coh_yx FROM (SELECT DISTINCT site, hour FROM hw) LEFT JOIN hv USING (site, hour))"""


def scored(t) -> DataFrame:
    """site, hour, coh_xy, coh_yx, score."""
    return hours.hour_scores(rax(t), ["site"], "i", HOUR, SEGMENT, (2.5, 20.0))


def sc(t) -> DataFrame:
    return scored(t).select("site", F.col("hour").alias("i"), "coh_xy", "coh_yx")


KINDS = ("remote", "stack", "obs")
# the three kinds sit on grids 5 % and 3 % apart, so a comparison of two kinds has to interpolate
SHIFT = "CASE kind WHEN 'stack' THEN 1.05 WHEN 'obs' THEN 0.97 ELSE 1.0 END"
TF = f"""tfa AS (SELECT s_nationkey AS site, CASE l_returnflag WHEN 'A' THEN 'remote' WHEN 'N' THEN 'stack' ELSE 'obs' END AS kind,
  CASE l_linestatus WHEN 'O' THEN 10.0 ELSE 1.0 END AS rate_hz, p_size AS k, count(*) AS n,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS mq,
  CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS md,
  CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) AS mt
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4),
tf AS (SELECT site, kind, rate_hz, 'r1' AS run, pow(10.0, k / 12.0) * {SHIFT} AS period, 'xy' AS comp,
    (20.0 + mq) / 10.0 AS re, (10.0 + 5.0 * md) / 10.0 AS im, (5.0 + mt) / (10.0 * sqrt(n)) AS err FROM tfa
  UNION ALL SELECT site, kind, rate_hz, 'r1' AS run, pow(10.0, k / 12.0) * {SHIFT} AS period, 'yx' AS comp,
    -(30.0 + 5.0 * mt) / 10.0 AS re, -(10.0 + mq) / 10.0 AS im, (5.0 + md) / (10.0 * sqrt(n)) AS err FROM tfa)"""

CURVE = ["site", "run", "kind", "rate_hz"]


def tf(t) -> DataFrame:
    """(site, run, kind, rate_hz, period, comp, re, im, err): two off-diagonal curves per station and kind."""
    li = (t.lineitem.groupBy("l_suppkey", "l_partkey", "l_returnflag", "l_linestatus")
          .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.count(F.lit(1)).alias("n"),
               F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("d"),
               F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("x")))
    kind = (F.when(F.col("l_returnflag") == "A", "remote").when(F.col("l_returnflag") == "N", "stack")
            .otherwise("obs"))
    g = (li.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
         .groupBy(F.col("s_nationkey").cast("bigint").alias("site"), kind.alias("kind"),
                  F.when(F.col("l_linestatus") == "O", 10.0).otherwise(1.0).alias("rate_hz"),
                  F.col("p_size").alias("k"))
         .agg(F.sum("n").alias("n"), (F.sum("q").cast("double") / F.sum("n")).alias("mq"),
              (F.sum("d").cast("double") / F.sum("n")).alias("md"),
              (F.sum("x").cast("double") / F.sum("n")).alias("mt")))
    q, d, x, r = F.col("mq"), F.col("md"), F.col("mt"), F.sqrt(F.col("n"))
    rows = F.array(
        F.struct(F.lit("xy").alias("comp"), ((20.0 + q) / 10.0).alias("re"), ((10.0 + 5.0 * d) / 10.0).alias("im"),
                 ((5.0 + x) / (10.0 * r)).alias("err")),
        F.struct(F.lit("yx").alias("comp"), (-(30.0 + 5.0 * x) / 10.0).alias("re"), (-(10.0 + q) / 10.0).alias("im"),
                 ((5.0 + d) / (10.0 * r)).alias("err")))
    return (g.withColumn("c", F.explode(rows))
            .select("site", F.lit("r1").alias("run"), "kind", "rate_hz",
                    (F.pow(F.lit(10.0), F.col("k") / 12.0) * F.when(F.col("kind") == "stack", 1.05).when(F.col("kind") == "obs", 0.97)
                     .otherwise(1.0)).alias("period"), "c.comp", "c.re", "c.im", "c.err"))


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
