"""The composite jobs end to end."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import delivery, recording, references
from .bind import EV, REC, rec, tf, with_
from .q_reference import B, ax, mb, wt
from .q_sources import sample_lines
from .registry import query


@query("recorded_samples", "site:s i:b hx:d ey:d", "K1 S3 J1", with_(EV, """l AS (SELECT 'S' || site AS site, CASE k % 2 WHEN 0 THEN 'hx' ELSE 'ey' END AS chan, (sec // 3600) * 36000 + k AS i, max(value) AS v FROM ev WHERE event_id % 50 <> 0 GROUP BY ALL)""")
       + "SELECT site, i, max(v) FILTER (WHERE chan = 'hx') AS hx, max(v) FILTER (WHERE chan = 'ey') AS ey FROM l GROUP BY ALL")
def recorded_samples(t):
    # one value per position: the larger where two events of one hour carry the same line number
    s = sample_lines(t).where(F.col("value").isNotNull()).groupBy("site", "chan", "pos").agg(F.max("value").alias("value"), F.first("file").alias("file"))
    return recording.record(s)


@query("record_reconciliation", "site:s chan:s samples_read:b overlap_samples:b files_read:b verdict:s", "A2 K1", with_(EV, """l AS (SELECT 'S' || site AS site, CASE k % 2 WHEN 0 THEN 'hx' ELSE 'ey' END AS chan, sec // 3600 AS h, k FROM ev),
p AS (SELECT site, chan, h, k, count(*) AS n FROM l GROUP BY ALL), f AS (SELECT site, chan, count(DISTINCT h) AS f FROM l GROUP BY ALL)""") + """SELECT p.site, p.chan, sum(n) AS samples_read, sum(n - 1) AS overlap_samples, max(f) AS files_read,
  CASE WHEN sum(n - 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM p JOIN f ON f.site = p.site AND f.chan = p.chan GROUP BY ALL""")
def record_reconciliation(t):
    s = sample_lines(t)
    return recording.reconciliation(s, s.groupBy("site", "chan").agg(F.countDistinct("file").alias("files_found")))


@query("reference_stack", "target:b i:b x:d mask:z n_members:b", "A15 W7 W6 W3 J2 D10")
def reference_stack(t):
    m = mb(t)
    obs = m.groupBy("target", "i").agg((F.max("x") + 5).alias("x")).withColumn("weight", F.lit(0.5))
    return references.build_stack(m, ax(t), wt(t), edge=1, observatory=obs, screen_k=2.0, level={"block": 7, "nwin": 8, "passes": 1}, block=B)


@query("delivered_rows", "site:b rate_hz:d comp:s kind:s period:d re:d im:d", "T3 P17 J21 K15")
def delivered_rows(t):
    return delivery.deliver(tf(t), ["site", "rate_hz", "comp"], "kind", "kind", slope_limit=1e9, held_bar=0.1)


@query("common_grid", "site:b kind:s rate_hz:d comp:s period:d re:d im:d", "J15 M8 K15")
def common_grid(t):
    d = tf(t).select("site", "kind", "rate_hz", "comp", "period", "re", "im", "err")
    return delivery.common_grid(d, ["site", "kind", "rate_hz"]).where(F.col("re").isNotNull())


@query("build_remote", "target:b i:b x:d mask:z", "T2", with_(REC) + "SELECT site AS target, i, coalesce(CASE WHEN site % 2 = 0 THEN hx ELSE ex END, 0) AS x, CASE WHEN site % 2 = 0 THEN hx ELSE ex END IS NOT NULL AS mask FROM rec")
def build_remote(t):
    d = rec(t).select(F.col("site").alias("target"), "i", F.explode(F.map_from_arrays(F.array(F.lit("hx"), F.lit("ex")), F.array("hx", "ex"))).alias("member", "x"))
    choice = d.select("target").distinct().withColumn("name", F.when(F.col("target") % 2 == 0, "hx").otherwise("ex"))
    return references.build_remote(d, choice)
