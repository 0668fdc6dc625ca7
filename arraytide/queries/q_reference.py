"""Sample screens, rolling windows and the reference series."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import axis, reference, robust
from .bind import CH, DAX, DAY_BLOCK, EV, REC, dax, rec, with_
from .q_register import PR, ST, km_sql, pr, st
from .registry import query

B = 128


@query("despike", "site:b i:b hx:d blanked:z", "W1", with_(REC, DAX, """d AS (SELECT *, lead(hx) OVER (PARTITION BY site ORDER BY i) - hx AS d FROM dax),
m AS (SELECT site, median(d) AS md FROM d GROUP BY site), s AS (SELECT d.site, 1.4826 * median(abs(d - md)) AS mad, count(d) AS nd FROM d JOIN m ON m.site = d.site GROUP BY d.site),
h AS (SELECT d.*, coalesce(nd >= 10 AND abs(d) > 1.5 * mad + 1e-9, false) AS hit FROM d LEFT JOIN s ON s.site = d.site),
b AS (SELECT *, bool_or(hit) OVER (PARTITION BY site ORDER BY i ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS blanked FROM h)""")
       + "SELECT site, i, CASE WHEN NOT blanked THEN hx END AS hx, blanked FROM b")
def despike(t):
    return robust.despike(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", k=1.5, block=B)


@query("fill_short_gaps", "site:b i:b hx:d filled:z", "W2 S11", with_(REC, DAX, """g AS (SELECT *, last_value(CASE WHEN hx IS NOT NULL THEN i END IGNORE NULLS) OVER w AS pi, last_value(hx IGNORE NULLS) OVER w AS pv,
  first_value(CASE WHEN hx IS NOT NULL THEN i END IGNORE NULLS) OVER x AS ni, first_value(hx IGNORE NULLS) OVER x AS nv FROM dax
  WINDOW w AS (PARTITION BY site ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), x AS (PARTITION BY site ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""")
       + """SELECT site, i, CASE WHEN hx IS NULL AND ni - pi - 1 <= 3 THEN pv + (nv - pv) * (i - pi) / (ni - pi) ELSE hx END AS hx, coalesce(hx IS NULL AND ni - pi - 1 <= 3, false) AS filled FROM g""")
def fill_short_gaps(t):
    return robust.fill_short(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", 3, block=B)


@query("widen_gaps", "site:b i:b hx:d", "W3", with_(REC, DAX) + """SELECT site, i, CASE WHEN count(*) FILTER (WHERE hx IS NULL) OVER (PARTITION BY site ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 0 THEN hx END AS hx FROM dax""")
def widen_gaps(t):
    return robust.widen_gaps(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", 1, block=B)


@query("edge_screen", "site:b i:b hx:d", "W3", with_(REC, DAX, """r AS (SELECT site, min(i) AS a, max(i) AS z FROM (SELECT site, i, i - row_number() OVER (PARTITION BY site ORDER BY i) AS g FROM rec) GROUP BY site, g)""")
       + """SELECT dax.site, dax.i, CASE WHEN dax.i - r.a >= 2 AND r.z - dax.i >= 2 THEN hx END AS hx FROM dax LEFT JOIN r ON r.site = dax.site AND dax.i BETWEEN r.a AND r.z""")
def edge_screen(t):
    return robust.screen_edges(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", 2, block=B)


@query("steps_per_million", "site:b n_steps:b n_diffs:b per_million:d", "A17", with_(REC, """d AS (SELECT site, abs(hx - lag(hx) OVER (PARTITION BY site ORDER BY i)) AS d FROM rec)""")
       + """SELECT site, count(*) FILTER (WHERE d > 20) AS n_steps, count(d) AS n_diffs, 1e6 * count(*) FILTER (WHERE d > 20) / greatest(count(d), 1) AS per_million FROM d GROUP BY site""")
def steps_per_million(t):
    return robust.steps_per_million(rec(t), ["site"], "i", "hx", 20.0, block=B)


@query("rolling_median", "site:b i:b smooth:d", "W14", with_(REC, DAX) + """SELECT site, i, median(hx) OVER (PARTITION BY site ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS smooth FROM dax""")
def rolling_median(t):
    return robust.rolling_median(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", 3, 3, "smooth", block=B)


LAG = 2.37
TAPS = ", ".join(f"({k}, CAST({w!r} AS DOUBLE))" for k, w in zip(range(-15, 17), robust.lanczos_weights(LAG - 2)))


@query("lanczos_shift", "site:b i:b hx:d", "W8", with_(REC, f"w(tap, wt) AS (VALUES {TAPS})", "f AS (SELECT site, i, hx FROM rec)",
       """y AS (SELECT a.site, a.i - 2 AS i, sum(wt * b.hx) AS v, count(b.hx) AS n FROM f a CROSS JOIN w JOIN f b ON b.site = a.site AND b.i = a.i + w.tap GROUP BY 1, 2)""")
       + "SELECT site, i, v AS hx FROM y WHERE n = 32")
def lanczos_shift(t):
    # nations have gaps at small scale; a position is answered only where all 32 taps are there
    d = robust.shift(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", LAG, block=B)
    return d.where(F.col("hx").isNotNull())


@query("lanczos_member_shift", "site:b i:b hx:d", "W8 J2")
def lanczos_member_shift(t):
    lag = F.when(F.col("site") % 3 == 0, 0.0).otherwise((F.col("site") % 7) / 4.0)
    d = robust.shift(dax(t).select("site", "i", "hx"), ["site"], "i", "hx", lag, block=B)
    return d.where(F.col("hx").isNotNull())


@query("decimation_blanks", "site:b slot:b n:b blank:z", "W9", with_(REC, DAX) + "SELECT site, i // 4 AS slot, count(hx) AS n, count(hx) < 4 AS blank FROM dax GROUP BY 1, 2")
def decimation_blanks(t):
    return robust.blank_decimated(dax(t), ["site"], "i", "hx", 4)


# ---------------------------------------------------------------- members of a region's stack

MB = """rx AS (SELECT n_regionkey AS target, rec.* FROM rec JOIN nation ON n_nationkey = site),
ax AS (SELECT target, min(i) AS t0, max(i) - min(i) + 1 AS n FROM rx GROUP BY target),
mb AS MATERIALIZED (SELECT a.target, m.member, a.i, rx.hx AS x FROM (SELECT target, unnest(generate_series(t0, t0 + n - 1)) AS i FROM ax) a
  JOIN (SELECT DISTINCT target, site AS member FROM rx) m ON m.target = a.target LEFT JOIN rx ON rx.site = m.member AND rx.i = a.i)"""


def ax(t):
    d = rec(t).join(t.nation, F.col("site") == F.col("n_nationkey"))
    return d.groupBy(F.col("n_regionkey").cast("bigint").alias("target")).agg(F.min("i").alias("t0"), (F.max("i") - F.min("i") + 1).alias("n"))


def mb(t):
    r = rec(t).join(t.nation, F.col("site") == F.col("n_nationkey")).select(F.col("n_regionkey").cast("bigint").alias("target"), F.col("site").alias("member"), "i", F.col("hx").alias("x"))
    spans = r.select("target", "member").distinct().join(ax(t), "target").select("target", "member", "t0", (F.col("t0") + F.col("n") - 1).alias("t1"))
    return axis.densify(r, ["target", "member"], "i", ["x"], spans, block=DAY_BLOCK)


SCR = """dd AS MATERIALIZED (SELECT *, x - lag(x) OVER (PARTITION BY member ORDER BY i) AS d FROM mb),
de AS (SELECT *, count(d) OVER w AS nfin, median(d) OVER w AS med, sum(abs(d)) OVER w AS abs_sum FROM dd WINDOW w AS (PARTITION BY target, i)),
df AS (SELECT *, CASE WHEN nfin >= 3 THEN d - med END AS r FROM de),
m3 AS (SELECT member, median(r) AS c3, median(d) AS c2 FROM df GROUP BY member),
mm AS (SELECT df.member, 1.4826 * median(abs(r - c3)) AS mad3, 1.4826 * median(abs(d - c2)) AS mad2 FROM df JOIN m3 ON m3.member = df.member GROUP BY df.member),
hh AS (SELECT df.*, coalesce(abs(r) > greatest(2.0 * mad3, 3.0), false) OR coalesce(nfin = 2 AND abs(d) > greatest(2.0 * mad2, 3.0) AND abs_sum - abs(d) < 1.5, false) AS hit FROM df JOIN mm ON mm.member = df.member),
hf AS (SELECT target, member, i, x, bool_or(hit) OVER (PARTITION BY member ORDER BY i ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS flagged FROM hh),
hg AS (SELECT *, last_value(CASE WHEN NOT flagged THEN i END IGNORE NULLS) OVER w AS pi, first_value(CASE WHEN NOT flagged THEN i END IGNORE NULLS) OVER y AS ni FROM hf
  WINDOW w AS (PARTITION BY member ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), y AS (PARTITION BY member ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
ms AS (SELECT hg.target, hg.member, hg.i, hg.flagged, hg.flagged AND coalesce(ni - pi - 1 <= 12, false) AND p.x IS NOT NULL AND q.x IS NOT NULL AS bridged,
  CASE WHEN NOT hg.flagged THEN hg.x WHEN ni - pi - 1 <= 12 THEN p.x + (q.x - p.x) * (hg.i - pi) / (ni - pi) END AS x
  FROM hg LEFT JOIN mb p ON p.member = hg.member AND p.i = pi LEFT JOIN mb q ON q.member = hg.member AND q.i = ni)"""


def screened(t):
    return reference.member_screen(mb(t), k=2.0, block=B)


@query("member_screen", "target:b member:b i:b x:d flagged:z bridged:z", "W7", with_(REC, MB, SCR) + "SELECT * FROM ms")
def member_screen(t):
    return screened(t)


@query("bridged_spans", "target:b span_start:b span_end:b", "W7 U4 S19", with_(REC, MB, SCR, """sp1 AS (SELECT target, member, min(i) AS a, max(i) + 1 AS b FROM (SELECT *, i - row_number() OVER (PARTITION BY member ORDER BY i) AS g FROM ms WHERE bridged) GROUP BY target, member, g),
sp2 AS (SELECT *, max(b) OVER (PARTITION BY target ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sp1),
sp3 AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY target ORDER BY a, b) AS g FROM sp2)""")
       + "SELECT target, min(a) AS span_start, max(b) AS span_end FROM sp3 GROUP BY target, g")
def bridged_spans(t):
    from ..operators import islands
    r = islands.runs(screened(t), ["target", "member"], "i", F.col("bridged"), block=B)
    r = r.select("target", F.col("run_start").alias("span_start"), (F.col("run_end") + 1).alias("span_end"))
    return islands.merge_intervals(r, ["target"], "span_start", "span_end", block=B)


@query("fleet_level", "target:b i:b level:d", "W6", with_(REC, MB) + "SELECT target, i, CASE WHEN count(x) >= 2 THEN median(x) END AS level FROM mb WHERE x IS NOT NULL GROUP BY 1, 2")
def fleet_level(t):
    return reference.fleet_level(mb(t))


def _pass(n: int, src: str, stat: str) -> str:
    return f"""lv{n} AS (SELECT target, i, CASE WHEN count(x) >= 2 THEN median(x) END AS level FROM {src} GROUP BY 1, 2),
r{n} AS (SELECT s.target, s.member, s.i, s.x, s.off, s.i - ax.t0 AS at, (s.i - ax.t0) // 7 AS b, ax.n, s.x - level AS r FROM {src} s JOIN ax ON ax.target = s.target LEFT JOIN lv{n} l ON l.target = s.target AND l.i = s.i),
b{n} AS (SELECT target, member, b, n, CASE WHEN count(r) >= 2 THEN median(r) END AS m FROM r{n} GROUP BY 1, 2, 3, 4),
w{n} AS (SELECT target, member, b * 7 + 3.0 AS c, CASE WHEN b >= 4 AND b <= ceil(n / 7.0) - 4 THEN {stat}(m) OVER (PARTITION BY member ORDER BY b ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) END AS v FROM b{n}),
n{n} AS (SELECT * FROM w{n} WHERE v IS NOT NULL),
i{n} AS (SELECT r.*, CASE WHEN p.c IS NULL THEN q.v WHEN q.c IS NULL THEN p.v WHEN q.c = p.c THEN p.v ELSE p.v + (q.v - p.v) * (r.at - p.c) / (q.c - p.c) END AS o
  FROM r{n} r ASOF LEFT JOIN n{n} p ON p.member = r.member AND r.at >= p.c ASOF LEFT JOIN n{n} q ON q.member = r.member AND r.at <= q.c),
a{n} AS (SELECT r.member, coalesce(avg(r.x) - coalesce(any_value(z.base), 0), 0) AS alone FROM r{n} r LEFT JOIN (SELECT target, avg(level) AS base FROM lv1 GROUP BY target) z ON z.target = r.target GROUP BY r.member),
x{n} AS (SELECT i.target, i.member, i.i, i.x - coalesce(o, alone) AS x, off + coalesce(o, alone) AS off FROM i{n} i JOIN a{n} a ON a.member = i.member)"""


LVL = f"""x0 AS (SELECT *, CAST(0 AS DOUBLE) AS off FROM mb), {_pass(1, 'x0', 'avg')}, {_pass(2, 'x1', 'median')},
bs AS (SELECT target, coalesce(avg(level), 0) AS base FROM lv1 GROUP BY target), lm AS (SELECT x2.target, member, i, x - base AS x, off FROM x2 JOIN bs ON bs.target = x2.target)"""


def levelled(t):
    return reference.level_match(mb(t), ax(t), block=7, nwin=8, min_frac=0.1, passes=2, axis_block=B)


@query("level_match", "target:b member:b i:b x:d off:d", "W6", with_(REC, MB, LVL) + "SELECT * FROM lm")
def level_match(t):
    return levelled(t)


@query("one_sided_offset", "target:b i:b x:d off:d", "W6 J11", with_(REC, MB, """ob AS (SELECT target, i, max(x) + 5 AS x FROM mb GROUP BY 1, 2), lv1 AS (SELECT target, i, CASE WHEN count(x) >= 2 THEN median(x) END AS level FROM mb GROUP BY 1, 2),
r1 AS (SELECT o.target, o.i, o.x, o.i - ax.t0 AS at, (o.i - ax.t0) // 7 AS b, ax.n, o.x - level AS r FROM ob o JOIN ax ON ax.target = o.target LEFT JOIN lv1 l ON l.target = o.target AND l.i = o.i),
b1 AS (SELECT target, b, n, CASE WHEN count(r) >= 2 THEN median(r) END AS m FROM r1 GROUP BY 1, 2, 3),
w1 AS (SELECT target, b * 7 + 3.0 AS c, CASE WHEN b >= 4 AND b <= ceil(n / 7.0) - 4 THEN median(m) OVER (PARTITION BY target ORDER BY b ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) END AS v FROM b1),
n1 AS (SELECT * FROM w1 WHERE v IS NOT NULL)""") + """SELECT r.target, r.i, x - coalesce(off, 0) AS x, coalesce(off, 0) AS off FROM (SELECT r.*, CASE WHEN p.c IS NULL THEN q.v WHEN q.c IS NULL THEN p.v WHEN q.c = p.c THEN p.v
  ELSE p.v + (q.v - p.v) * (r.at - p.c) / (q.c - p.c) END AS off FROM r1 r ASOF LEFT JOIN n1 p ON p.target = r.target AND r.at >= p.c ASOF LEFT JOIN n1 q ON q.target = r.target AND r.at <= q.c) r""")
def one_sided_offset(t):
    m = mb(t)
    obs = m.groupBy("target", "i").agg((F.max("x") + 5).alias("x"))
    return reference.one_sided_offset(obs, reference.fleet_level(m), ax(t), block=7, nwin=8, passes=1, axis_block=B)


WT = """wt AS (SELECT DISTINCT target, member, (1 + member % 4) / 4.0 AS weight FROM mb)"""


def wt(t):
    n = t.nation.select(F.col("n_regionkey").cast("bigint").alias("target"), F.col("n_nationkey").cast("bigint").alias("member"))
    return n.withColumn("weight", (1 + F.col("member") % 4) / 4.0)


STK = """sk AS (SELECT mb.target, i, sum(weight * x) AS nu, sum(weight) AS de, count(*) AS n_members FROM mb JOIN wt ON wt.member = mb.member WHERE x IS NOT NULL GROUP BY 1, 2),
sf AS (SELECT target, i, CASE WHEN n_members >= 2 THEN nu / de ELSE 0 END AS x, n_members >= 2 AS mask, n_members FROM sk)"""


@query("weighted_stack", "target:b i:b x:d mask:z n_members:b", "A15 D10", with_(REC, MB, WT, STK) + "SELECT * FROM sf")
def weighted_stack(t):
    return reference.stack(mb(t), wt(t))


@query("stack_with_observatory", "target:b i:b x:d mask:z n_members:b", "A15 J11", with_(REC, MB, WT, STK, """ob AS (SELECT target, i, max(x) + 5 AS x FROM mb GROUP BY 1, 2)""") + """SELECT ob.target, ob.i, CASE WHEN coalesce(n_members, 0) >= 2 THEN (nu + 0.5 * ob.x) / (de + 0.5) ELSE 0 END AS x,
  coalesce(n_members, 0) >= 2 AS mask, coalesce(n_members, 0) AS n_members FROM ob LEFT JOIN sk ON sk.target = ob.target AND sk.i = ob.i WHERE ob.x IS NOT NULL""")
def stack_with_observatory(t):
    m = mb(t)
    obs = m.groupBy("target", "i").agg((F.max("x") + 5).alias("x")).withColumn("weight", F.lit(0.5))
    return reference.stack(m, wt(t), others=obs)


@query("count_profile", "target:b fewest:b frac_zero:d frac_lt_half:d frac_full:d samples_below:b", "A16", with_(REC, MB, """c AS (SELECT target, i, count(x) AS c FROM mb GROUP BY 1, 2), nm AS (SELECT target, count(DISTINCT member) AS k FROM mb GROUP BY 1)""")
       + """SELECT c.target, min(c) AS fewest, avg(CASE WHEN c = 0 THEN 1.0 ELSE 0 END) AS frac_zero, avg(CASE WHEN c < greatest(1, k // 2) THEN 1.0 ELSE 0 END) AS frac_lt_half,
  avg(CASE WHEN c = k THEN 1.0 ELSE 0 END) AS frac_full, count(*) FILTER (WHERE c < 2) AS samples_below FROM c JOIN nm ON nm.target = c.target GROUP BY c.target""")
def count_profile(t):
    m = mb(t)
    n = m.groupBy("target").agg(F.countDistinct("member").alias("n_members"))
    return reference.count_profile(reference.stack(m, wt(t)), ax(t), n)


# ---------------------------------------------------------------- candidates and choices

CAND = f"""ext AS (SELECT site, min(i) AS a, max(i) + 1 AS z, count(hx) AS used FROM rec GROUP BY site),
ef AS (SELECT site, avg(CASE WHEN hx > 60 THEN 1.0 ELSE 0.0 END) AS event_frac FROM rec GROUP BY site),
cd AS (SELECT ta.site AS target, cb.site AS name, {km_sql('ta', 'cb')} AS km, CAST(least(x.z, y.z) - greatest(x.a, y.a) AS DOUBLE) AS overlap_days, CAST(x.z - x.a AS DOUBLE) AS own_days,
  CAST(x.used AS DOUBLE) AS usable_days, ef.event_frac, ef.event_frac <= 0.22 AS clean, 0.4 + 4 * pr.c AS coh FROM st ta JOIN st cb ON ta.site <> cb.site JOIN ext x ON x.site = ta.site
  JOIN ext y ON y.site = cb.site JOIN ef ON ef.site = cb.site LEFT JOIN pr ON pr.a = least(ta.site, cb.site) AND pr.b = greatest(ta.site, cb.site)),
ct AS (SELECT *, overlap_days / own_days AS overlap_frac, least(20.0, 0.75 * least(CASE WHEN usable_days > 0 THEN usable_days ELSE own_days END, own_days)) AS floor_days FROM cd),
ck AS (SELECT * REPLACE (CASE WHEN overlap_days >= floor_days THEN coh END AS coh), overlap_days >= floor_days AS ok FROM ct)"""


def cands(t):
    from ..functions import geo
    s = st(t)
    r = rec(t)
    ext = r.groupBy("site").agg(F.min("i").alias("a"), (F.max("i") + 1).alias("z"), F.count("hx").cast("double").alias("used"),
                                F.avg(F.when(F.col("hx") > 60, 1.0).otherwise(0.0)).alias("event_frac"))
    own = s.join(ext, "site").select(F.col("site").alias("target"), F.col("lat").alias("la"), F.col("lon").alias("lo"), F.col("a").alias("xa"), F.col("z").alias("xz"), F.col("used").alias("usable_days"))
    other = s.join(ext, "site").select(F.col("site").alias("name"), "lat", "lon", "a", "z", "event_frac")
    # the pair table of the fleet names the pairs; each is scored from both its ends
    both = pr(t).select(F.explode(F.array(F.struct(F.col("a").alias("target"), F.col("b").alias("name"), "c"), F.struct(F.col("b").alias("target"), F.col("a").alias("name"), "c"))).alias("p")).select("p.*")
    d = both.join(own, "target").join(other, "name")
    return d.select("target", "name", geo.distance_km(F.col("la"), F.col("lo"), F.col("lat"), F.col("lon")).alias("km"),
                    (F.least("xz", "z") - F.greatest("xa", "a")).cast("double").alias("overlap_days"), (F.col("xz") - F.col("xa")).cast("double").alias("own_days"),
                    "usable_days", "event_frac", (F.col("event_frac") <= 0.22).alias("clean"), (0.4 + 4 * F.col("c")).alias("coh"))


@query("candidate_table", "target:b name:b km:d overlap_days:d overlap_frac:d floor_days:d ok:z coh:d clean:z", "J9", with_(REC, ST, PR, CAND) + "SELECT * FROM ck")
def candidate_table(t):
    return reference.candidate_table(cands(t))


RULE = """rb AS (SELECT *, CASE WHEN NOT ok THEN 6 WHEN clean AND coalesce(coh, -1) >= 0.5 AND overlap_frac >= 0.9 THEN 1 WHEN clean AND coalesce(coh, -1) >= 0.5 THEN 2 WHEN clean AND coalesce(coh, -1) >= 0.3 THEN 3
  WHEN coalesce(coh, -1) >= 0.5 THEN 4 ELSE 5 END AS b FROM ck),
rc AS (SELECT target, name, least(b, 5) AS branch, CASE WHEN b <= 5 THEN coh END AS coh FROM rb QUALIFY row_number() OVER (PARTITION BY target ORDER BY b,
  CASE b WHEN 2 THEN -overlap_days WHEN 3 THEN -coalesce(coh, -1) WHEN 4 THEN event_frac ELSE km END, km, name) = 1)"""


@query("remote_choice", "target:b name:b branch:b coh:d", "T1", with_(REC, ST, PR, CAND, RULE) + "SELECT * FROM rc")
def remote_choice(t):
    return reference.remote_choice(reference.candidate_table(cands(t)))


@query("remote_named", "target:b remote:s branch:b rule_name:b rule_branch:b source:s", "T1", with_(REC, ST, PR, CAND, RULE) + """SELECT target, CASE WHEN target % 3 = 0 THEN 'S' || (target + 1) ELSE CAST(name AS VARCHAR) END AS remote,
  CASE WHEN target % 3 = 0 THEN 0 ELSE branch END AS branch, name AS rule_name, branch AS rule_branch, CASE WHEN target % 3 = 0 THEN 'decisions' ELSE 'rule' END AS source FROM rc""")
def remote_named(t):
    k = F.col("n_nationkey")
    dec = t.nation.select(k.cast("bigint").alias("target"), F.when(k % 3 == 0, F.concat(F.lit("S"), (k + 1).cast("string"))).when(k % 3 == 1, "decide").otherwise("none").alias("remote_site"))
    return reference.with_named_remote(reference.remote_choice(reference.candidate_table(cands(t))), dec)


@query("top_members", "target:b name:b weight:d role:s note:s", "T2 P18", with_(REC, ST, PR, CAND, """fw AS (SELECT site, median(c) AS weight FROM (SELECT a AS site, 0.4 + 4 * c AS c FROM pr UNION ALL SELECT b, 0.4 + 4 * c FROM pr) GROUP BY site),
ln AS (SELECT n_nationkey AS site, CASE WHEN n_nationkey % 6 = 0 THEN n_nationkey + 1 END AS lender FROM nation),
tm AS (SELECT ck.target, ck.name, fw.weight, CASE WHEN lc.lender IS NOT NULL THEN 'its field is borrowed' WHEN ck.name = lt.lender THEN 'it lends to the target' WHEN NOT ok THEN CASE WHEN overlap_days <= 0 THEN 'no overlap' ELSE 'overlap under the floor' END
  WHEN fw.weight IS NULL OR fw.weight <= 0 THEN 'no fleet coherence' WHEN fw.weight < 0.38 THEN 'fleet coherence under the cutoff' END AS note FROM ck LEFT JOIN fw ON fw.site = ck.name LEFT JOIN ln lc ON lc.site = ck.name LEFT JOIN ln lt ON lt.site = ck.target),
tr AS (SELECT *, row_number() OVER (PARTITION BY target, note IS NULL ORDER BY weight DESC, name DESC) AS r FROM tm)""") + """SELECT target, name, CASE WHEN note IS NULL AND r <= 4 THEN weight END AS weight, CASE WHEN note IS NULL AND r <= 4 THEN 'member' ELSE 'refused' END AS role,
  coalesce(note, CASE WHEN r > 4 THEN 'outside the best 4' ELSE '' END) AS note FROM tr""")
def top_members(t):
    c = reference.candidate_table(cands(t))
    ends = pr(t).select(F.explode(F.array("a", "b")).alias("site"), (0.4 + 4 * F.col("c")).alias("c"))
    fw = ends.groupBy("site").agg(F.median("c").alias("weight"))
    k = F.col("n_nationkey").cast("bigint")
    lenders = t.nation.select(k.alias("site"), F.when(k % 6 == 0, k + 1).alias("lender"))
    return reference.stack_members(reference.lender_refusal(c, lenders), fw, cutoff=0.38, n_max=4)
