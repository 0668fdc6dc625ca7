"""Decisions, frames, daily tests and station verdicts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rotation
from ..operators import decisions, intervals, site, tables
from .bind import CH, DAX, DAY_BLOCK, REC, TF, dax, rec, tf, with_
from .q_register import ST, km_sql, st
from .q_tables import OLD, old
from .registry import query

DEC = """dc AS (SELECT n_nationkey AS site, CASE n_nationkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'decide' ELSE 'no' END AS e_exchange, CASE n_nationkey % 4 WHEN 1 THEN 'y' ELSE 'n' END AS h_exchange, CASE n_nationkey % 5 WHEN 2 THEN 'assume:1.25' ELSE '' END AS h_gain,
  '0' AS e_shift_s, CASE n_nationkey % 2 WHEN 0 THEN '-1' ELSE 'decide' END AS sign_ex, '1' AS sign_ey, '' AS sign_hx, '+1' AS sign_hy, CASE n_nationkey % 7 WHEN 3 THEN '-1' ELSE '1' END AS sign_hz,
  CASE n_nationkey % 6 WHEN 5 THEN 'S1' ELSE 'none' END AS h_lender, 'all' AS h_lender_channels, CASE n_nationkey % 8 WHEN 0 THEN '' ELSE '50' END AS dipole_n_m, 'assume:60' AS dipole_e_m FROM nation)"""


def dec(t):
    k = F.col("n_nationkey")
    w = lambda m, d, e: (lambda c: c.otherwise(e))(_when(k % m, d))
    return t.nation.select(k.cast("bigint").alias("site"), w(3, {0: "yes", 1: "decide"}, "no").alias("e_exchange"), w(4, {1: "y"}, "n").alias("h_exchange"), w(5, {2: "assume:1.25"}, "").alias("h_gain"),
                           F.lit("0").alias("e_shift_s"), w(2, {0: "-1"}, "decide").alias("sign_ex"), F.lit("1").alias("sign_ey"), F.lit("").alias("sign_hx"), F.lit("+1").alias("sign_hy"), w(7, {3: "-1"}, "1").alias("sign_hz"),
                           w(6, {5: "S1"}, "none").alias("h_lender"), F.lit("all").alias("h_lender_channels"), w(8, {0: ""}, "50").alias("dipole_n_m"), F.lit("assume:60").alias("dipole_e_m"))


def _when(c, d):
    out = F
    for v, s in d.items():
        out = out.when(c == v, F.lit(s))
    return out


@query("apply_decisions", "site:b i:b hx:d hy:d hz:d ex:d ey:d", "P7 P8 J18 S17", with_(REC, DAX, DEC, """e1 AS (SELECT dax.*, n_site, CASE WHEN n_site % 3 = 0 THEN dax.ey * CASE WHEN n_site % 8 = 0 THEN 1 ELSE 60.0 / 50.0 END ELSE dax.ex END AS ex1, CASE WHEN n_site % 3 = 0 THEN dax.ex * CASE WHEN n_site % 8 = 0 THEN 1 ELSE 50.0 / 60.0 END ELSE dax.ey END AS ey1,
  CASE WHEN n_site % 5 = 2 THEN 1.25 ELSE 1 END AS g FROM (SELECT *, site AS n_site FROM dax) dax)""", """d1 AS (SELECT site, i, CASE WHEN site % 4 = 1 THEN hy ELSE hx END / g AS hx, CASE WHEN site % 4 = 1 THEN hx ELSE hy END / g AS hy, hz / g * CASE WHEN site % 7 = 3 THEN -1 ELSE 1 END AS hz,
  ex1 * CASE WHEN site % 2 = 0 THEN -1 ELSE 1 END AS ex, ey1 AS ey FROM e1)""", """an AS (SELECT site, atan2(avg(hy), avg(hx)) AS a FROM d1 WHERE hx IS NOT NULL GROUP BY site), le AS (SELECT site + 1 AS site, i, hx * 2 AS lx, hy + 1 AS ly, hz AS lz FROM dax)""")
       + """SELECT d1.site, d1.i, CASE WHEN d1.site % 6 = 5 THEN cos(a) * lx - sin(a) * ly ELSE hx END AS hx, CASE WHEN d1.site % 6 = 5 THEN sin(a) * lx + cos(a) * ly ELSE hy END AS hy, CASE WHEN d1.site % 6 = 5 THEN lz ELSE hz END AS hz, ex, ey
  FROM d1 JOIN an ON an.site = d1.site LEFT JOIN le ON le.site = d1.site AND le.i = d1.i""")
def apply_decisions(t):
    d = dax(t)
    lender = d.select((F.col("site") + 1).alias("site"), "i", (F.col("hx") * 2).alias("l_hx"), (F.col("hy") + 1).alias("l_hy"), F.col("hz").alias("l_hz"))
    return decisions.apply_decisions(d, decisions.decision_values(dec(t), "site"), "site", "i", lender=lender, block=DAY_BLOCK)


@query("applied_log", "site:b applied:s open:s inter_site:z", "P7 K14", with_(DEC) + """SELECT site, concat_ws(' ', CASE WHEN site % 3 = 0 THEN 'e_exchange' END, CASE WHEN site % 4 = 1 THEN 'h_exchange' END, CASE WHEN site % 5 = 2 THEN 'h_gain' END, CASE WHEN site % 7 = 3 THEN 'sign_hz' END,
  CASE WHEN site % 2 = 0 THEN 'sign_ex' END, CASE WHEN site % 6 = 5 THEN 'h_lender' END) AS applied, concat_ws(' ', CASE WHEN site % 3 = 1 THEN 'e_exchange' END, CASE WHEN site % 5 <> 2 THEN 'h_gain' END, 'sign_hx', CASE WHEN site % 2 = 1 THEN 'sign_ex' END) AS open, site % 6 = 5 AS inter_site FROM dc""")
def applied_log(t):
    return decisions.applied_log(decisions.decision_values(dec(t), "site"), "site")


@query("mean_field_rotation", "site:b i:b hx:d hy:d angle:d", "W23 A21 M2", with_(REC, DAX, """r AS (SELECT site, i, CASE WHEN i BETWEEN lo + 100 AND lo + 199 THEN NULL ELSE hx END AS hx, CASE WHEN i BETWEEN lo + 100 AND lo + 199 THEN NULL ELSE hy END AS hy,
  CASE WHEN site % 2 = 0 THEN 0 WHEN i < lo + 500 THEN 1 WHEN i >= lo + 800 THEN 2 ELSE -1 END AS reg FROM (SELECT *, min(i) OVER (PARTITION BY site) AS lo FROM dax)),
a AS (SELECT site, reg, degrees(atan2(avg(hy), avg(hx))) AS angle FROM r WHERE hx IS NOT NULL AND hy IS NOT NULL AND reg >= 0 GROUP BY ALL)""") + """SELECT r.site, i, cos(radians(angle)) * hx + sin(radians(angle)) * hy AS hx, -sin(radians(angle)) * hx + cos(radians(angle)) * hy AS hy, angle FROM r LEFT JOIN a ON a.site = r.site AND a.reg = r.reg""")
def mean_field_rotation(t):
    d = dax(t)
    lo = rec(t).groupBy("site").agg(F.min("i").alias("lo"))
    null = F.lit(None).cast("bigint")
    reg = lo.where(F.col("site") % 2 != 0).select("site", F.explode(F.array(F.struct(F.col("lo").alias("p0"), (F.col("lo") + 500).alias("p1")), F.struct((F.col("lo") + 800).alias("p0"), null.alias("p1")))).alias("r")).select("site", "r.*")
    drop = lo.select("site", (F.col("lo") + 100).alias("p0"), (F.col("lo") + 200).alias("p1"))
    return decisions.rotate_to_mean_field(d, ["site"], "i", reg, drop)


@query("dc_test", "site:b f_ratio:d h_ratio:d angle_deg:d tilt_deg:d flags:s verdict:s", "A4", with_(REC, """m AS (SELECT site, median(hx) - 20 AS bx, median(ey * 10) - 2 AS b2, -median(hy) AS bz, 20.0 + site / 2.0 AS x, 3.0 AS y, -60.0 - site AS z FROM rec GROUP BY site),
r AS (SELECT *, sqrt(bx * bx + b2 * b2) AS h, sqrt(bx * bx + b2 * b2 + bz * bz) AS f, sqrt(x * x + y * y) AS hi, sqrt(x * x + y * y + z * z) AS fi FROM m),
q AS (SELECT site, f / fi AS f_ratio, h / hi AS h_ratio, degrees(atan2(b2, bx)) AS angle_deg, degrees(atan2(h, -bz) - atan2(hi, -z)) AS tilt_deg, bx, bz / z AS zr FROM r),
g AS (SELECT *, concat_ws('; ', CASE WHEN abs(f_ratio - 1) > 0.05 THEN 'gain' WHEN abs(zr - 1) > 0.1 OR abs(h_ratio - 1) > 0.1 THEN 'tilt' END, CASE WHEN bx < 0 THEN 'Bx negative' END, CASE WHEN abs(angle_deg) > 30 THEN 'angle' END) AS flags FROM q)""")
       + "SELECT *, CASE WHEN flags = '' THEN 'PASS' ELSE 'CHECK' END AS verdict FROM g")
def dc_test(t):
    return decisions.dc_test(_dc(t))


def _dc(t):
    s = F.col("site")
    return rec(t).groupBy("site").agg((F.median("hx") - 20).alias("bx"), (F.median(F.col("ey") * 10) - 2).alias("by"), (-F.median("hy")).alias("bz")).withColumns(
        {"igrf_x": 20.0 + s / 2.0, "igrf_y": F.lit(3.0), "igrf_z": -60.0 - s})


DCT = """m AS (SELECT site, median(hx) - 20 AS bx, median(ey * 10) - 2 AS b2, -median(hy) AS bz, 20.0 + site / 2.0 AS x, 3.0 AS y, -60.0 - site AS z FROM rec GROUP BY site),
q AS (SELECT *, sqrt(bx * bx + b2 * b2 + bz * bz) / sqrt(x * x + y * y + z * z) AS fr, sqrt(bx * bx + b2 * b2) / sqrt(x * x + y * y) AS hr FROM m),
g AS (SELECT site, bx / x AS rx, bz / z AS rz, abs(fr - 1) > 0.05 OR abs(bz / z - 1) > 0.1 OR abs(hr - 1) > 0.1 OR abs(degrees(atan2(b2, bx))) > 30 AS bad FROM q),
l AS (SELECT site, 'sign_hx' AS c, rx AS r, bad FROM g UNION ALL SELECT site, 'sign_hz', rz, bad FROM g)"""


@query("signs_from_dc", "site:b column:s value:b reason:s", "M5 P20", with_(REC, DCT) + """SELECT site, c AS "column", CASE WHEN NOT bad AND abs(r) >= 0.3 THEN CASE WHEN r > 0 THEN 1 ELSE -1 END END AS value, CASE WHEN bad THEN 'flagged' WHEN abs(r) < 0.3 THEN 'inside the floor' ELSE 'outside the floor' END AS reason FROM l""")
def signs_from_dc(t):
    return decisions.signs_from_dc(decisions.dc_test(_dc(t)), "site")


# nations as stations, months as days
MON = """mo AS (SELECT site, i // 30 AS day, CASE WHEN count(*) >= 12 THEN stddev_pop(ex) END AS std_ex, CASE WHEN count(*) >= 12 THEN stddev_pop(ey) END AS std_ey, 0.5 + covar_pop(ex, hx) / nullif(stddev_pop(ex) * stddev_pop(hx), 0) / 2 AS coh_ex_hy, 0.5 + covar_pop(ey, hy) / nullif(stddev_pop(ey) * stddev_pop(hy), 0) / 2 AS coh_ey_hx, 0.3 + covar_pop(ex, ey) / nullif(stddev_pop(ex) * stddev_pop(ey), 0) AS coh_ex_ey FROM rec GROUP BY 1, 2 HAVING count(*) > 4)"""


def _corr(a, b):
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def mon(t):
    n = F.count(F.lit(1))
    return rec(t).groupBy("site", F.floor(F.col("i") / 30).alias("day")).agg(n.alias("n"), F.when(n >= 12, F.stddev_pop("ex")).alias("std_ex"), F.when(n >= 12, F.stddev_pop("ey")).alias("std_ey"), (0.5 + _corr("ex", "hx") / 2).alias("coh_ex_hy"),
                                                                             (0.5 + _corr("ey", "hy") / 2).alias("coh_ey_hx"), (0.3 + _corr("ex", "ey")).alias("coh_ex_ey")).where(F.col("n") > 4)


STT = """th AS (SELECT site, 0.8 * median(std_ex) AS dx, 0.8 * median(std_ey) AS dy FROM mo GROUP BY site),
sg AS (SELECT mo.*, CASE WHEN std_ex IS NULL THEN 'gap' WHEN std_ex < dx THEN 'dead' WHEN coh_ex_hy >= 0.4 AND coh_ex_ey < 0.5 THEN 'sound' WHEN coh_ex_ey >= 0.6 AND coh_ex_hy < 0.3 THEN 'common' ELSE 'weak' END AS ex_state,
  CASE WHEN std_ey IS NULL THEN 'gap' WHEN std_ey < dy THEN 'dead' WHEN coh_ey_hx >= 0.4 AND coh_ex_ey < 0.5 THEN 'sound' WHEN coh_ex_ey >= 0.6 AND coh_ey_hx < 0.3 THEN 'common' ELSE 'weak' END AS ey_state FROM mo JOIN th ON th.site = mo.site)"""


def states(t):
    return decisions.line_states(mon(t), ["site"], {"ex": "coh_ex_hy", "ey": "coh_ey_hx"}, 0.8)


@query("line_summary", "site:b days_total:b days_scored:b ex_sound:b ex_weak:b ex_dead:b ex_gap:b ex_longest_sound:b ey_sound:b both_sound:b ex_sound_frac:d", "A5", with_(REC, MON, STT, """rn AS (SELECT site, max(n) AS m FROM (SELECT site, g, count(*) AS n FROM
  (SELECT site, ex_state, row_number() OVER (PARTITION BY site ORDER BY day) - row_number() OVER (PARTITION BY site, ex_state ORDER BY day) AS g FROM sg) WHERE ex_state = 'sound' GROUP BY site, g) GROUP BY site)""") + """SELECT s.*, coalesce(m, 0) AS ex_longest_sound, ex_sound / CAST(greatest(1, days_scored) AS DOUBLE) AS ex_sound_frac FROM
  (SELECT site, count(*) AS days_total, count(*) FILTER (WHERE ex_state <> 'gap' OR ey_state <> 'gap') AS days_scored, count(*) FILTER (WHERE ex_state = 'sound') AS ex_sound, count(*) FILTER (WHERE ex_state = 'weak') AS ex_weak, count(*) FILTER (WHERE ex_state = 'dead') AS ex_dead,
  count(*) FILTER (WHERE ex_state = 'gap') AS ex_gap, count(*) FILTER (WHERE ey_state = 'sound') AS ey_sound, count(*) FILTER (WHERE ex_state = 'sound' AND ey_state = 'sound') AS both_sound FROM sg GROUP BY site) s LEFT JOIN rn ON rn.site = s.site""")
def line_summary(t):
    return decisions.line_summary(states(t), ["site"], ["ex", "ey"], "day")


@query("state_window", "site:b rule:s t_start:b t_end:b n_days:b", "W4 K13")
def state_window(t):
    from ..operators import stretches
    d = tables.numbered(states(t), ["site"], ["day"]).select("site", F.col("n").cast("bigint").alias("n"), "ex_state", (F.col("day") * 30).alias("a"), (F.col("day") * 30 + 30).alias("z"))
    return stretches.longest_state_run(d, ["site"], "n", "ex_state", "a", "z", ["sound"], ["sound", "weak"], 60, 1)


@query("control_site", "group:s site:b mx:d days:b qualifies:z", "A29", with_(REC, MON, """g AS (SELECT site, max(coh_ex_ey) AS mx, median(coh_ex_ey) AS md, count(*) AS days FROM mo WHERE coh_ex_ey IS NOT NULL GROUP BY site)""") + """SELECT CAST(n_regionkey AS VARCHAR) AS "group", site, mx, days, mx < 0.35 AS qualifies FROM g JOIN nation ON n_nationkey = site
  QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY round(mx, 12), round(md, 12), site) = 1""")
def control_site(t):
    return site.control_site(mon(t), t.nation.select(F.col("n_nationkey").cast("bigint").alias("site"), F.col("n_regionkey").cast("string").alias("group")))


@query("top_days", "site:b day:b coh_ex_ey:d rank:b", "T5", with_(REC, MON) + "SELECT site, day, coh_ex_ey, row_number() OVER (PARTITION BY site ORDER BY coh_ex_ey DESC, day) AS rank FROM mo WHERE std_ex IS NOT NULL AND coh_ex_ey IS NOT NULL QUALIFY rank <= 3")
def top_days(t):
    return site.top_days(mon(t), ["site"], "coh_ex_ey", "day", F.col("std_ex").isNotNull())


MAG = f"""dm AS (SELECT site, i // 30 AS day, CASE WHEN count(*) >= 12 THEN median(hx) / 60.0 END AS f, stddev_pop(hx) AS x, stddev_pop(hz) AS z FROM rec GROUP BY 1, 2),
nb AS (SELECT a.site, b.site AS name FROM st a JOIN st b ON a.site <> b.site QUALIFY row_number() OVER (PARTITION BY a.site ORDER BY round({km_sql('a', 'b')}, 9), b.site) <= 2),
rf AS (SELECT nb.site, dm.day, count(*) AS n, median(x) AS rx, median(z) AS rz FROM nb JOIN dm ON dm.site = nb.name WHERE f IS NOT NULL GROUP BY 1, 2),
dj AS (SELECT dm.*, n, rx, rz, coalesce(abs(f - 1) < 0.05, false) AS fo FROM dm LEFT JOIN rf ON rf.site = dm.site AND rf.day = dm.day),
dk AS (SELECT *, f IS NOT NULL AND n IS NOT NULL AS judged, CASE WHEN f IS NULL THEN false WHEN n IS NULL THEN fo ELSE fo AND x BETWEEN rx / 3 AND rx * 3 AND z BETWEEN rz / 3 AND rz * 3 END AS sound FROM dj)"""


@query("daily_magnetics", "site:b day:b f_ratio:d n_neighbours:b sound:z judged:z reason:s", "J8 A22", with_(REC, ST, MAG) + """SELECT site, day, f AS f_ratio, coalesce(n, 0) AS n_neighbours, sound, judged, CASE WHEN f IS NULL THEN 'no data' WHEN NOT judged THEN 'F only: no neighbour recorded that day' WHEN sound THEN '' WHEN NOT fo THEN 'F off the model' ELSE 'fluctuation off the neighbours' END AS reason FROM dk""")
def daily_magnetics(t):
    n = F.count(F.lit(1))
    d = rec(t).groupBy("site", F.floor(F.col("i") / 30).alias("day")).agg(F.when(n >= 12, F.median("hx") / 60.0).alias("f_ratio"), F.stddev_pop("hx").alias("hx_std"), F.stddev_pop("hz").alias("hz_std"))
    return site.daily_magnetics(d, st(t))


@query("forms_verdict", "site:b form:s verdict:s n_controls:b candidate:z", "A24 T7", """WITH f AS (SELECT o_custkey AS site, o_orderpriority AS form, median(o_totalprice) AS bar, CASE WHEN count(*) % 5 = 0 THEN 'refused' WHEN count(*) % 7 = 0 THEN 'failed' ELSE 'made' END AS status, o_orderpriority = '4-NOT SPECIFIED' AS inter_site FROM orders GROUP BY 1, 2),
c AS (SELECT f.site, f.form, count(*) AS n, bool_and(f.bar <= 0.8 * k.bar) AS w FROM f JOIN f k ON k.site = f.site AND k.form IN ('5-LOW', '3-MEDIUM') AND k.status = 'made' WHERE f.form IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') GROUP BY ALL)
SELECT f.site, f.form, CASE WHEN status = 'refused' THEN 'refused' WHEN status <> 'made' THEN 'NOT MADE' WHEN inter_site THEN 'inter-site: not a response' WHEN f.form IN ('5-LOW', '3-MEDIUM') THEN 'read, no control' WHEN n IS NULL THEN 'UNJUDGED: no control was made' WHEN w THEN 'beats its controls' ELSE 'does not beat its controls' END AS verdict,
  coalesce(n, 0) AS n_controls, coalesce(w AND status = 'made' AND NOT inter_site, false) AS candidate FROM f LEFT JOIN c ON c.site = f.site AND c.form = f.form""")
def forms_verdict(t):
    n = F.count(F.lit(1))
    p = F.col("form")
    f = t.orders.groupBy(F.col("o_custkey").alias("site"), F.col("o_orderpriority").alias("form")).agg(F.median("o_totalprice").alias("bar"), F.when(n % 5 == 0, "refused").when(n % 7 == 0, "failed").otherwise("made").alias("status"))
    ctl = F.when(p.isin("5-LOW", "3-MEDIUM"), F.array().cast("array<string>")).otherwise(F.array(F.lit("5-LOW"), F.lit("3-MEDIUM")))
    return site.forms_table(f.withColumns({"controls": ctl, "inter_site": p == "4-NOT SPECIFIED", "judged_on": F.lit("bar")}))


@query("verdict_counts", "name:s pass:b fail:b unjudged:b failed:z", "A28", """WITH v AS (SELECT c_mktsegment AS name, c_custkey % 11 AS n_scored, c_acctbal > 0 AS ok FROM customer) SELECT name, count(*) FILTER (WHERE n_scored > 0 AND ok) AS "pass", count(*) FILTER (WHERE n_scored > 0 AND NOT ok) AS fail,
  count(*) FILTER (WHERE n_scored = 0) AS unjudged, count(*) FILTER (WHERE n_scored = 0 OR NOT ok) > 0 AS failed FROM v GROUP BY name""")
def verdict_counts(t):
    d = t.customer.select(F.col("c_mktsegment").alias("name"), (F.col("c_custkey") % 11).alias("n_scored"), F.when(F.col("c_acctbal") > 0, "PASS").otherwise("FAIL").alias("verdict"))
    return site.verdict_counts(d, ["name"])


@query("manifest_check", "path:s exists:z sha256_matches:z bytes:b", "K11 K12", """WITH m AS (SELECT 'd/' || doc_id AS path, sha256(text) AS h, octet_length(encode(text)) AS bytes, doc_id FROM documents)
SELECT path, doc_id % 10 <> 0 AS exists, doc_id % 10 <> 0 AND doc_id % 7 <> 0 AS sha256_matches, bytes FROM m""")
def manifest_check(t):
    files = t.documents.select(F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"), "doc_id")
    rec_ = site.manifest(files)
    found = site.manifest(files.where(F.col("doc_id") % 10 != 0).withColumn("content", F.when(F.col("doc_id") % 7 == 0, F.lit(b"changed")).otherwise(F.col("content"))))
    return site.manifest_check(rec_, found).join(rec_.select("path", "bytes"), "path")


@query("run_caveats", "key:b input:s state:s", "K14", f"""WITH {OLD}, u AS (SELECT key, unnest(['notes', 'prio', 'status']) AS c, unnest([notes, prio, status]) AS v FROM old)
SELECT key, CASE WHEN lower(v) LIKE 'assume:%' THEN c || '=' || substr(v, 8) ELSE c END AS input, CASE WHEN lower(v) LIKE 'assume:%' THEN 'assumed' ELSE 'open' END AS state FROM u WHERE lower(trim(v)) = 'decide' OR lower(v) LIKE 'assume:%'""")
def run_caveats(t):
    return site.caveats(tables.open_cells(old(t), "key", ["status", "prio", "notes"]), "key", "undecided", "assumed")


# ---------------------------------------------------------------- frames and tensors

@query("arm_diagonals", "site:b i:b e_d:d e_v:d theta:d gain:d", "M2", with_(REC) + """SELECT site, i, (50.0 * ex - (40.0 + site) * ey) / sqrt(2500.0 + (40.0 + site) * (40.0 + site)) AS e_d, ((40.0 + site) * ex + 50.0 * ey) / sqrt(2500.0 + (40.0 + site) * (40.0 + site)) AS e_v,
  degrees(atan2(-(40.0 + site), 50.0)) AS theta, 50.0 / (40.0 + site) AS gain FROM rec""")
def arm_diagonals(t):
    ln, le = F.lit(50.0), 40.0 + F.col("site")
    d, v = rotation.diagonals(F.col("ex"), F.col("ey"), ln, le)
    return rec(t).select("site", "i", d.alias("e_d"), v.alias("e_v"), rotation.diagonal_angle(ln, le).alias("theta"), rotation.expected_gain(ln, le).alias("gain"))


TEN = """te AS (SELECT site, round(period, 6) AS period, max(re) FILTER (WHERE comp = 'xy') AS b, max(re) FILTER (WHERE comp = 'yx') AS c, max(err) FILTER (WHERE comp = 'xy') AS eb, max(err) FILTER (WHERE comp = 'yx') AS ec, max(im) FILTER (WHERE comp = 'xy') AS a,
  max(im) FILTER (WHERE comp = 'yx') AS d, radians(-45.0 + site) AS t FROM tf WHERE kind = 'remote' AND rate_hz = 1 GROUP BY 1, 2 HAVING count(*) = 2)"""


def ten(t):
    d = tf(t).where((F.col("kind") == "remote") & (F.col("rate_hz") == 1))
    m = lambda c, k, n: F.max(F.when(F.col("comp") == k, F.col(c))).alias(n)
    return d.groupBy("site", F.round("period", 6).alias("period")).agg(m("re", "xy", "b"), m("re", "yx", "c"), m("err", "xy", "eb"), m("err", "yx", "ec"), m("im", "xy", "a"), m("im", "yx", "d"), F.count(F.lit(1)).alias("n")).where(F.col("n") == 2)


@query("tensor_turn", "site:b period:d z00:d z01:d z10:d z11:d det:d frob:d", "M3 A27", with_(TF, TEN) + """SELECT site, period, cos(t) * p + sin(t) * q AS z00, -sin(t) * p + cos(t) * q AS z01, cos(t) * r + sin(t) * s AS z10, -sin(t) * r + cos(t) * s AS z11, a * d - b * c AS det, sqrt(a * a + b * b + c * c + d * d) AS frob FROM
  (SELECT *, cos(t) * a + sin(t) * c AS p, cos(t) * b + sin(t) * d AS q, -sin(t) * a + cos(t) * c AS r, -sin(t) * b + cos(t) * d AS s FROM te)""")
def tensor_turn(t):
    z = [[F.col("a"), F.col("b")], [F.col("c"), F.col("d")]]
    r = rotation.turn_frame(z, -45.0 + F.col("site"))
    d = ten(t).select("site", "period", *[r[i][j].alias(f"z{i}{j}") for i in (0, 1) for j in (0, 1)])
    c = F.col
    return d.withColumns({"det": c("z00") * c("z11") - c("z01") * c("z10"), "frob": F.sqrt(c("z00") ** 2 + c("z01") ** 2 + c("z10") ** 2 + c("z11") ** 2)})


@query("basis_correction", "site:b period:d z01:d z10:d e01:d", "M3 J18", with_(TF, TEN) + """SELECT site, period, CASE WHEN site % 2 = 0 THEN -a * sin(t) + b * cos(t) ELSE a * 0 + b END AS z01, CASE WHEN site % 2 = 0 THEN c * cos(t) + d * sin(t) - 0 ELSE c END AS z10,
  CASE WHEN site % 2 = 0 THEN sqrt(pow(eb * -sin(t), 2) + pow(ec * cos(t), 2)) ELSE ec END AS e01 FROM te""")
def basis_correction(t):
    # both channels borrowed on even stations: the correction is the rotation back; none on odd ones: the identity
    b = F.col("site") % 2 == 0
    cm = rotation.basis_correction(-45.0 + F.col("site"), b, b)
    z = rotation.right([[F.col("a"), F.col("b")], [F.col("c"), F.col("d")]], cm)
    e = rotation.right_errors([[F.col("eb"), F.col("ec")], [F.col("ec"), F.col("eb")]], cm)
    return ten(t).select("site", "period", z[0][1].alias("z01"), z[1][0].alias("z10"), e[0][1].alias("e01"))


@query("named_windows", "key:b t_start:b t_end:b hours:d ok:z", "P19", """SELECT o_orderkey AS key, CASE WHEN h > 0 AND k <> 3 THEN epoch_us(o_orderdate) // 1000000 END AS t_start, CASE WHEN h > 0 AND k <> 3 THEN epoch_us(o_orderdate) // 1000000 + h * 3600 END AS t_end, CASE WHEN h > 0 AND k <> 3 THEN h ELSE 0 END AS hours, h > 0 AND k <> 3 AS ok
  FROM (SELECT *, o_custkey % 50 - 5 AS h, o_orderkey % 4 AS k FROM orders)""")
def named_windows(t):
    h = F.col("o_custkey") % 50 - 5
    when = F.when(F.col("o_orderkey") % 4 == 3, "not a time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    d = t.orders.select(F.col("o_orderkey").alias("key"), F.concat(F.lit("window:"), when, F.lit("/"), h.cast("string")).alias("spec"))
    w = intervals.named_window(F.col("spec"))
    return d.select("key", *[c.alias(n) for n, c in w.items()]).withColumn("ok", F.col("t_start").isNotNull())


@query("parse_regimes", "key:b day0:d day1:d", "P19 D3", """WITH c AS (SELECT o_orderkey AS key, o_custkey % 9 AS a, o_orderkey % 5 AS m FROM orders) SELECT key, a AS day0, a + 3 AS day1 FROM c WHERE m IN (0, 1) UNION ALL SELECT key, 0, a FROM c WHERE m = 2 UNION ALL SELECT key, a + 20, NULL FROM c WHERE m IN (1, 3)""")
def parse_regimes(t):
    a, m = (F.col("o_custkey") % 9), F.col("o_orderkey") % 5
    s = lambda c: c.cast("string")
    ab = F.concat(s(a), F.lit(":"), s(a + 3))
    cell = F.when(m == 0, ab).when(m == 1, F.concat(ab, F.lit(", "), s(a + 20), F.lit(":"))).when(m == 2, F.concat(F.lit(":"), s(a), F.lit(" x:y"))).when(m == 3, F.concat(s(a + 20), F.lit(": junk"))).otherwise("decide")
    return t.orders.select(F.col("o_orderkey").alias("key"), F.explode(intervals.regimes(cell)).alias("r")).select("key", "r.*")


# pairs of nations whose keys are at most four apart, with two coherences from account sums
LC = """pr AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b, ((a.n_nationkey * b.n_nationkey + a.n_nationkey + b.n_nationkey) % 97) / 97.0 AS coh_hx, ((a.n_nationkey + b.n_nationkey) * 31 % 89) / 89.0 AS coh_hy
  FROM nation a, nation b WHERE a.n_nationkey <> b.n_nationkey AND abs(a.n_nationkey - b.n_nationkey) <= 4),
nr AS (SELECT a AS site, b AS candidate, abs(a - b) * 100.0 AS km, (a * 7 + b) % 21 / 20.0 AS coverage FROM pr)"""


def lender_pairs(t):
    k = F.col("n_nationkey").cast("bigint")
    d = t.nation.select(k.alias("a"), F.explode(F.array(*[k + s for s in (-4, -3, -2, -1, 1, 2, 3, 4)])).alias("b"))
    d = d.join(t.nation.select(k.alias("b")), "b")
    a, b = F.col("a"), F.col("b")
    return d.select("a", "b", ((a * b + a + b) % 97 / 97.0).alias("coh_hx"), ((a + b) * 31 % 89 / 89.0).alias("coh_hy"))


@query("lender_candidates", "site:b candidate:b km:d third:b worst_channel:s donor_sound:z rule_fires:z covers:z", "J19", with_(LC, """th AS (SELECT n.site, n.candidate, p.b AS third, p.coh_hx, p.coh_hy FROM nr n JOIN nr m ON m.site = n.site AND m.candidate <> n.candidate JOIN pr p ON p.a = n.candidate AND p.b = m.candidate
  QUALIFY row_number() OVER (PARTITION BY n.site, n.candidate ORDER BY round(least(p.coh_hx, p.coh_hy), 12) DESC, p.b DESC) = 1),
j AS (SELECT n.*, o.coh_hx AS ox, o.coh_hy AS oy, third, th.coh_hx AS tx, th.coh_hy AS ty, CASE WHEN o.coh_hx < o.coh_hy THEN 'hx' ELSE 'hy' END AS worst_channel FROM nr n JOIN pr o ON o.a = n.site AND o.b = n.candidate LEFT JOIN th ON th.site = n.site AND th.candidate = n.candidate)""") + """
SELECT site, candidate, km, third, worst_channel, coalesce(CASE worst_channel WHEN 'hx' THEN tx ELSE ty END >= 0.8, false) AS donor_sound,
  coalesce(least(ox, oy) < 0.5 AND least(ox, oy) < 0.7 * greatest(ox, oy) AND CASE worst_channel WHEN 'hx' THEN tx ELSE ty END >= 0.8, false) AS rule_fires, coverage >= 0.95 AS covers FROM j""")
def lender_candidates(t):
    p = lender_pairs(t)
    near = p.select(F.col("a").alias("site"), F.col("b").alias("candidate"), (F.abs(F.col("a") - F.col("b")) * 100.0).alias("km"), ((F.col("a") * 7 + F.col("b")) % 21 / 20.0).alias("coverage"))
    return site.lender_candidates(p, near)


@query("tipper_refusal", "site:b coh_own:d refused:z reason:s", "J20", """WITH c AS (SELECT o_custkey AS site, max(o_orderkey % 101) / 100.0 AS hz_hx, min(o_orderkey % 53 + 40) / 92.0 AS hz_hy, min(o_orderkey % 37) / 36.0 AS hz_neighbour FROM orders GROUP BY 1)
SELECT site, greatest(hz_hx, hz_hy) AS coh_own, hz_hx >= 0.99 OR (greatest(hz_hx, hz_hy) >= 0.95 AND hz_neighbour < 0.1) AS refused, concat_ws('; ', CASE WHEN hz_hx >= 0.99 THEN 'a copy' END, CASE WHEN greatest(hz_hx, hz_hy) >= 0.95 AND hz_neighbour < 0.1 THEN 'a leak' END) AS reason FROM c""")
def tipper_refusal(t):
    k = F.col("o_orderkey")
    c = t.orders.groupBy(F.col("o_custkey").alias("site")).agg((F.max(k % 101) / 100.0).alias("hz_hx"), (F.min(k % 53 + 40) / 92.0).alias("hz_hy"), (F.min(k % 37) / 36.0).alias("hz_neighbour"))
    return site.tipper_refusal(c)


@query("sign_prediction", "site:b s_pred:d undecided:s", "M5", with_(DEC, "n AS (SELECT site, CASE WHEN sign_ex IN ('1', '+1', '-1') THEN CAST(sign_ex AS DOUBLE) END AS x, CASE WHEN sign_ey IN ('1', '+1', '-1') THEN CAST(sign_ey AS DOUBLE) END AS y FROM dc)")
       + "SELECT site, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN CASE WHEN (x > 0) = (y > 0) THEN 1.0 ELSE -1.0 END END AS s_pred, concat_ws(', ', CASE WHEN x IS NULL THEN 'Ex' END, CASE WHEN y IS NULL THEN 'Ey' END) AS undecided FROM n")
def sign_prediction(t):
    return decisions.sign_prediction(dec(t), "site")
