"""Response curves: tests, agreement, choice, merge and splice."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import names, scalars
from ..operators import curves, readings, splice
from .bind import REC, TF, tf, with_
from .registry import query

SCAL = """sl AS (SELECT *, 0.2 * period * (re * re + im * im) AS rho, CASE WHEN ph0 > 180 THEN ph0 - 360 ELSE ph0 END AS ph, err / sqrt(re * re + im * im) AS rel FROM
  (SELECT *, degrees(atan2(im, re)) + CASE comp WHEN 'yx' THEN 180.0 ELSE 0.0 END AS ph0 FROM tf))"""
W = ["site", "rate_hz", "comp"]
IN = "site:b rate_hz:d comp:s"


def _pts(name: str, lo: float, hi: float, clamp: bool = True, src: str = "sl", pairs: str | None = None) -> str:
    """Points of curve a with curve b interpolated there, by two as-of joins per point."""
    pairs = pairs or "a.kind < b.kind"
    edge = "WHEN n1.period IS NULL THEN n2.{c} WHEN n2.period IS NULL THEN n1.{c}" if clamp else "WHEN n1.period IS NULL OR n2.period IS NULL THEN NULL"
    line = lambda c: "CASE " + edge.format(c=c) + f" WHEN n1.period = n2.period THEN n1.{c} ELSE n1.{c} + (n2.{c} - n1.{c}) * (q.lx - n1.lx) / (n2.lx - n1.lx) END"
    return f"""{name}k AS (SELECT DISTINCT site, rate_hz, comp, kind FROM {src}), {name}n AS (SELECT site, rate_hz, comp, kind, period, ln(period) AS lx, ln(rho) AS lr, ph,
  count(*) OVER (PARTITION BY site, rate_hz, comp, kind) AS nb FROM {src}),
{name}q AS (SELECT a.site, a.rate_hz, a.comp, a.kind AS a, b.kind AS b, p.period, p.lx, p.lr, p.ph FROM {name}k a JOIN {name}k b ON a.site = b.site AND a.rate_hz = b.rate_hz AND a.comp = b.comp AND {pairs}
  JOIN {name}n p ON p.site = a.site AND p.rate_hz = a.rate_hz AND p.comp = a.comp AND p.kind = a.kind AND p.period BETWEEN {lo} AND {hi}),
{name} AS (SELECT q.site, q.rate_hz, q.comp, q.a, q.b, q.period, exp({line('lr')} - q.lr) AS ratio, (({line('ph')} - q.ph + 180.0) % 360.0 + 360.0) % 360.0 - 180.0 AS dphi, coalesce(n1.nb, n2.nb) AS nb
  FROM {name}q q ASOF LEFT JOIN {name}n n1 ON n1.site = q.site AND n1.rate_hz = q.rate_hz AND n1.comp = q.comp AND n1.kind = q.b AND q.period >= n1.period
  ASOF LEFT JOIN {name}n n2 ON n2.site = q.site AND n2.rate_hz = q.rate_hz AND n2.comp = q.comp AND n2.kind = q.b AND q.period <= n2.period)"""


def pts(t, lo, hi, outside="clamp"):
    d = tf(t)
    return curves.paired(d, curves.pair_list(d, W, "kind"), W, "kind", outside, lo, hi)


@query("rho_phase", "site:b kind:s rate_hz:d comp:s period:d rho:d rho_err:d phase:d phase_err:d", "M4 D8", with_(TF, SCAL) + """SELECT site, kind, rate_hz, comp, period, rho, 2 * rho * rel AS rho_err, ph AS phase, degrees(rel) AS phase_err FROM sl""")
def rho_phase(t):
    return scalars.with_scalars(tf(t))


@query("mask_components", "site:b kind:s rate_hz:d comp:s period:d re:d im:d err:d", "P13", with_(TF, """m AS (SELECT site, kind, rate_hz, comp, period, CASE WHEN k = 0 THEN 1e32 WHEN k = 1 THEN 0 ELSE re END AS re, CASE WHEN k <= 1 THEN 0 ELSE im END AS im,
  CASE WHEN k = 2 THEN 1e9 WHEN k = 1 AND rate_hz = 1 THEN 0 ELSE err END AS err FROM (SELECT *, CAST(round(err * 10000) AS BIGINT) % 9 AS k FROM tf)),
b AS (SELECT *, sqrt(re * re + im * im) >= 1e30 OR err >= 1e9 OR (re = 0 AND im = 0 AND NOT (err > 0 AND err < 1e9)) AS bad FROM m)""") + """SELECT site, kind, rate_hz, comp, period, CASE WHEN NOT bad THEN re END AS re, CASE WHEN NOT bad THEN im END AS im, CASE WHEN NOT bad THEN err END AS err FROM b""")
def mask_components(t):
    k = F.round(F.col("err") * 10000).cast("bigint") % 9
    d = tf(t).withColumn("k", k).withColumns({"re": F.when(F.col("k") == 0, 1e32).when(F.col("k") == 1, 0.0).otherwise(F.col("re")), "im": F.when(F.col("k") <= 1, 0.0).otherwise(F.col("im")),
                                              "err": F.when(F.col("k") == 2, 1e9).when((F.col("k") == 1) & (F.col("rate_hz") == 1), 0.0).otherwise(F.col("err"))})
    return curves.mask(d)


@query("unique_periods", "site:b comp:s period:d re:d kind:s", "S20 U2", with_(TF) + """SELECT site, comp, round(period, 1) AS period, re, kind FROM tf QUALIFY row_number() OVER (PARTITION BY site, comp, round(period, 1) ORDER BY err, kind, rate_hz) = 1""")
def unique_periods(t):
    d = tf(t).withColumn("period", F.round("period", 1)).withColumn("_o", F.struct("err", "kind", "rate_hz"))
    return curves.unique_periods(d, ["site"], "_o")


@query("response_tests", IN + " kind:s phase_frac:d median_phase_deg:d slope_frac:d bar:d n_periods:b rho_bar:d held_lo_s:d held_hi_s:d held_n:b passes:z fails:s", "A13 A12", with_(TF, SCAL, """b AS (SELECT *, period BETWEEN 10 AND 1000 AS band FROM sl),
s AS (SELECT site, rate_hz, comp, kind, avg(CASE WHEN abs((log10(rho) - ly) / (log10(period) - lx)) <= 2.5 THEN 1.0 ELSE 0.0 END) AS slope_frac FROM (SELECT *, log10(lag(rho) OVER w) AS ly, log10(lag(period) OVER w) AS lx FROM b WHERE band
  WINDOW w AS (PARTITION BY site, rate_hz, comp, kind ORDER BY period)) WHERE lx IS NOT NULL GROUP BY ALL),
g AS (SELECT site, rate_hz, comp, kind, avg(CASE WHEN ph > 0 AND ph < 90 THEN 1.0 ELSE 0.0 END) FILTER (WHERE band) AS phase_frac, median(ph) FILTER (WHERE band) AS median_phase_deg, median(rel) FILTER (WHERE band) AS bar,
  count(*) FILTER (WHERE band AND rel < 1) AS n_periods, 2 * median(rel) FILTER (WHERE band) AS rho_bar, min(period) FILTER (WHERE rel < 0.1 AND ph BETWEEN 0 AND 90) AS held_lo_s, max(period) FILTER (WHERE rel < 0.1 AND ph BETWEEN 0 AND 90) AS held_hi_s,
  count(*) FILTER (WHERE rel < 0.1 AND ph BETWEEN 0 AND 90) AS held_n FROM b GROUP BY ALL)""") + """SELECT *, fails = '' AS passes FROM (SELECT g.*, slope_frac, concat_ws('; ', CASE WHEN NOT phase_frac >= 0.7 THEN 'phase' END, CASE WHEN NOT slope_frac >= 0.8 THEN 'slope' END,
  CASE WHEN NOT (bar <= 1 AND n_periods >= 8) THEN 'error' END) AS fails FROM g JOIN s USING (site, rate_hz, comp, kind))""")
def response_tests(t):
    return readings.response_tests(tf(t), [*W, "kind"], slope_limit=2.5, held_bar=0.1)


AGR = """ag AS (SELECT site, rate_hz, comp, a, b, count(*) AS n, median(abs(ratio - 1)) AS rho_dev, median(abs(dphi)) AS phase_dev_deg, median(ratio) AS rho_ratio, median(dphi) AS phase_diff_deg,
  round(median(abs(ratio - 1)), 12) <= 0.2 AND round(median(abs(dphi)), 12) <= 5 AS agrees FROM {src} GROUP BY ALL)"""


@query("agreement_pairs", IN + " a:s b:s n:b rho_dev:d phase_dev_deg:d rho_ratio:d phase_diff_deg:d agrees:z", "J16 J15", with_(TF, SCAL, _pts("pt", 5.0, 200.0), AGR.format(src="pt")) + "SELECT * FROM ag")
def agreement_pairs(t):
    return curves.agreement(pts(t, 5.0, 200.0), [*W, "a", "b"])


@query("agreement_counts", "site:b rate_hz:d pairs:b agreeing:b worst_rho_ratio:d", "A30", with_(TF, SCAL, _pts("pt", 5.0, 200.0), AGR.format(src="pt")) + """SELECT site, rate_hz, count(*) AS pairs, count(*) FILTER (WHERE ok) AS agreeing, max(w) AS worst_rho_ratio FROM
  (SELECT site, rate_hz, a, b, bool_and(agrees) AS ok FROM ag GROUP BY ALL) JOIN (SELECT site, rate_hz, arg_max(rho_ratio, (round(abs(ln(rho_ratio)), 12), a, b)) AS w FROM ag GROUP BY ALL) USING (site, rate_hz) GROUP BY ALL""")
def agreement_counts(t):
    return readings.agreement_counts(curves.agreement(pts(t, 5.0, 200.0), [*W, "a", "b"]), ["site", "rate_hz"])


@query("band_stats", IN + " a:s b:s lo:d hi:d n:b rho_ratio:d spread:d phase_diff_deg:d", "A12 A23", with_(TF, SCAL, _pts("pt", 0.0, 1e9), """bd AS (SELECT * FROM (VALUES (5.0, 10.0), (10.0, 100.0), (100.0, 1000.0), (1000.0, 10000.0)) v(lo, hi)),
g AS (SELECT site, rate_hz, comp, a, b, lo, hi, count(ratio) AS n, median(ratio) AS m, quantile_cont(ratio, 0.75) / greatest(quantile_cont(ratio, 0.25), 1e-30) AS s, median(dphi) AS p FROM pt JOIN bd ON period >= lo AND period < hi GROUP BY ALL)""")
       + "SELECT site, rate_hz, comp, a, b, lo, hi, n, CASE WHEN n >= 4 THEN m END AS rho_ratio, CASE WHEN n >= 4 THEN s END AS spread, CASE WHEN n >= 4 THEN p END AS phase_diff_deg FROM g")
def band_stats(t):
    return curves.band_stats(pts(t, 0.0, 1e9), [*W, "a", "b"], curves.DECADES)


@query("worst_change", "comp:s rate_hz:d site:b a:s b:s rho_ratio:d", "T9", with_(TF, SCAL, _pts("pt", 5.0, 200.0), AGR.format(src="pt")) + "SELECT comp, rate_hz, site, a, b, rho_ratio FROM ag QUALIFY row_number() OVER (PARTITION BY site, rate_hz ORDER BY round(abs(ln(rho_ratio)), 12) DESC, a, b, comp) = 1")
def worst_change(t):
    return splice.worst_change(curves.agreement(pts(t, 5.0, 200.0), [*W, "a", "b"]), ["site", "rate_hz"])


# every curve of one rate is read against the other kinds of that rate
RDT = """rt AS (SELECT site, rate_hz, comp, kind, median(rel) AS bar, max(period) FILTER (WHERE rel < 0.1 AND ph BETWEEN 0 AND 90) AS held_hi_s, avg(CASE WHEN ph > 0 AND ph < 90 THEN 1.0 ELSE 0.0 END) >= 0.99 AND median(rel) <= 0.1 AS passes
  FROM sl WHERE period BETWEEN 10 AND 1000 GROUP BY ALL),
an AS (SELECT ag.site, ag.rate_hz, ag.comp, a AS kind, count(DISTINCT b) AS agree_n, string_agg(DISTINCT b, ' ' ORDER BY b) AS agree_kinds FROM ag JOIN rt x ON x.site = ag.site AND x.rate_hz = ag.rate_hz AND x.comp = ag.comp AND x.kind = a AND x.passes
  JOIN rt y ON y.site = ag.site AND y.rate_hz = ag.rate_hz AND y.comp = ag.comp AND y.kind = b AND y.passes WHERE agrees GROUP BY ALL),
rd AS (SELECT rt.*, coalesce(agree_n, 0) AS agree_n, coalesce(agree_kinds, '') AS agree_kinds FROM rt LEFT JOIN an USING (site, rate_hz, comp, kind))"""
RD_ALL = (TF, SCAL, _pts("pt", 5.0, 200.0, pairs="a.kind <> b.kind"), AGR.format(src="pt"), RDT)


def rd(t):
    return readings.readings_table(tf(t), W, "kind", "kind", quadrant_min=0.99, slope_limit=1e9, bar_max=0.1, min_periods=0, held_bar=0.1)


@query("readings_table", IN + " kind:s bar:d passes:z agree_kinds:s agree_n:b", "A14", with_(*RD_ALL) + "SELECT * FROM rd")
def readings_table(t):
    # bar ceiling and the count under it move together; the count floor is off so that both statements read alike
    return rd(t)


@query("record_choice", IN + " response:s bar:d n_sound:b n_pool:b n_read:b why:s", "T3", with_(*RD_ALL, """h AS (SELECT site, rate_hz, comp, kind, max(period) FILTER (WHERE rel < 0.1 AND ph BETWEEN 0 AND 90) AS hh FROM sl GROUP BY ALL),
p AS (SELECT rd.*, hh FROM rd JOIN h USING (site, rate_hz, comp, kind) WHERE passes AND agree_n > 0 QUALIFY row_number() OVER (PARTITION BY site, rate_hz, comp ORDER BY round(bar, 12), hh DESC, kind) = 1),
c AS (SELECT site, rate_hz, comp, count(*) FILTER (WHERE passes) AS n_sound, count(*) FILTER (WHERE passes AND agree_n > 0) AS n_pool, count(*) AS n_read FROM rd GROUP BY ALL)""") + """SELECT c.*, coalesce(p.kind, 'none') AS response, p.bar,
  CASE WHEN n_pool > 0 THEN 'the smallest bar among the rows that pass and agree with another kind' WHEN n_sound > 0 THEN 'rows pass and none agrees with another kind' ELSE 'no row passes the three tests' END AS why
  FROM c LEFT JOIN p USING (site, rate_hz, comp)""")
def record_choice(t):
    return readings.response_of_record(rd(t), W, "kind")


@query("record_alternatives", IN + " kind:s bar:d rank:b", "T3 T8", with_(*RD_ALL) + "SELECT site, rate_hz, comp, kind, bar, row_number() OVER (PARTITION BY site, rate_hz, comp ORDER BY bar, kind) AS rank FROM rd WHERE passes")
def record_alternatives(t):
    return readings.alternatives(rd(t), W, "kind")


@query("unique_tf_names", "site:b name:s n:b", "A14", """WITH r AS (SELECT o_custkey AS site, o_orderpriority AS name, 'run' || (o_orderkey % 3) AS run, o_orderkey // 1000 AS path FROM orders), f AS (SELECT site, name, count(DISTINCT path) AS f FROM r GROUP BY ALL)
SELECT r.site, CASE WHEN f > 1 THEN r.name || '@' || run ELSE r.name END AS name, count(*) AS n FROM r JOIN f ON f.site = r.site AND f.name = r.name GROUP BY ALL""")
def unique_tf_names(t):
    k = F.col("o_orderkey")
    r = t.orders.select(F.col("o_custkey").alias("site"), F.col("o_orderpriority").alias("name"), F.concat(F.lit("run"), (k % 3).cast("string")).alias("run"), F.floor(k / 1000).alias("path"))
    return readings.unique_names(r, ["site"], "name", "run", "path").groupBy("site", "name").agg(F.count(F.lit(1)).alias("n"))


@query("deliverable", "key:b why:s", "P15 S18", """SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'the single reference kind is never delivered' WHEN o_custkey % 3 = 1 THEN 'a form no section makes' ELSE '' END AS why FROM orders""")
def deliverable(t):
    c = F.col("o_custkey")
    d = t.orders.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderstatus") == "F", "single").otherwise("stack").alias("kind"),
                        F.when(c % 3 == 0, "recipe_x").when(c % 3 == 1, "window_zz").otherwise("").alias("form"))
    return readings.deliverable(d, "kind", names.is_form, "form")


@query("asof_nearest", "site:b comp:s period:d src_period:d src_re:d", "J14", with_(TF, """a AS (SELECT * FROM tf WHERE kind = 'remote' AND rate_hz = 1), b AS (SELECT site, comp, period * 1.05 * (1 + (CAST(round(err * 1000) AS BIGINT) % 5) * 0.004) AS period, re FROM tf WHERE kind = 'remote' AND rate_hz = 10),
c AS (SELECT site, comp, period / 1.05 AS period, re FROM b)""") + """SELECT site, comp, period, src_period, src_re FROM (SELECT a.site, a.comp, a.period, c.period AS src_period, c.re AS src_re,
  row_number() OVER (PARTITION BY a.site, a.comp, a.period ORDER BY abs(ln(a.period) - ln(c.period)), c.period) AS rn FROM a LEFT JOIN c ON c.site = a.site AND c.comp = a.comp AND abs(ln(a.period) - ln(c.period)) < ln(1.01)) WHERE rn = 1""")
def asof_nearest(t):
    d = tf(t).where(F.col("kind") == "remote")
    a = d.where(F.col("rate_hz") == 1).select("site", "comp", "period")
    b = d.where(F.col("rate_hz") == 10).withColumn("period", F.col("period") * 1.05 * (1 + (F.round(F.col("err") * 1000).cast("bigint") % 5) * 0.004) / 1.05)
    return curves.align_nearest(a, b, ["site", "comp"], ["re"])


GRID_SQL = "SELECT unnest(generate_series(5, 47)) AS k"


CV = "site, kind, rate_hz, comp"
SAME = lambda n: " AND ".join(f"g.{c} = {n}.{c}" for c in CV.split(", "))


def on_grid(t):
    """Every curve of every station, kind and rate, and the ten-per-decade periods that it may be asked for."""
    d = tf(t).select("site", "kind", "rate_hz", "comp", "period", "re", "im", "err")
    g = d.select("site", "kind", "rate_hz", "comp").distinct().withColumn("k", F.explode(F.sequence(F.lit(5), F.lit(47))))
    return d, g.withColumn("period", F.pow(F.lit(10.0), F.col("k") / 10.0))


@query("interp_join", "site:b kind:s rate_hz:d comp:s k:b re:d im:d err:d", "J15 W18 M8", with_(TF, f"""n0 AS (SELECT {CV}, log10(period) AS lx, log10(sqrt(re * re + im * im)) AS mag, atan2(im, re) AS ang, log10(err) AS le FROM tf),
n1 AS (SELECT *, ang - lag(ang) OVER (PARTITION BY {CV} ORDER BY lx) AS d FROM n0),
n AS (SELECT *, ang - 2 * pi() * sum(coalesce(round(d / (2 * pi())), 0)) OVER (PARTITION BY {CV} ORDER BY lx) AS ph FROM n1),
g AS (SELECT {CV}, k, CAST(log10(pow(10.0, k / 10.0)) AS DOUBLE) AS x FROM (SELECT DISTINCT {CV} FROM n), ({GRID_SQL})),
j AS (SELECT g.*, a.lx AS ax, b.lx AS bx, a.mag + coalesce((b.mag - a.mag) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS m, a.ph + coalesce((b.ph - a.ph) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS p,
  a.le + coalesce((b.le - a.le) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS e FROM g ASOF LEFT JOIN n a ON {SAME("a")} AND g.x >= a.lx ASOF LEFT JOIN n b ON {SAME("b")} AND g.x <= b.lx)""")
       + f"SELECT {CV}, k, pow(10, m) * cos(p) AS re, pow(10, m) * sin(p) AS im, pow(10, e) AS err FROM (SELECT {CV}, k, CASE WHEN ax IS NOT NULL AND bx - ax <= 0.3 THEN m END AS m, CASE WHEN bx - ax <= 0.3 THEN p END AS p, CASE WHEN bx - ax <= 0.3 THEN e END AS e FROM j)")
def interp_join(t):
    return curves.on_periods(*on_grid(t), ["site", "kind", "rate_hz"])


@query("trim_band", "site:b kind:s rate_hz:d comp:s period:d re:d applied:z", "P17", with_(TF, f"""b AS (SELECT DISTINCT {CV}, CASE WHEN site % 4 = 0 THEN 1e6 WHEN comp = 'xy' THEN 20.0 ELSE 50.0 END AS lo,
  CASE WHEN site % 4 = 0 THEN 1e7 ELSE 900.0 END AS hi FROM tf), l AS (SELECT {CV}, period, re, period BETWEEN lo AND hi AS live FROM tf JOIN b USING ({CV})), w AS (SELECT *, bool_or(live) OVER (PARTITION BY site, kind, rate_hz) AS applied FROM l)""")
       + f"SELECT {CV}, period, re, applied FROM w WHERE NOT applied OR live")
def trim_band(t):
    d, k = tf(t).select("site", "kind", "rate_hz", "comp", "period", "re", "im", "err"), ["site", "kind", "rate_hz"]
    b = d.select(*k, "comp").distinct().select(*k, "comp", F.when(F.col("site") % 4 == 0, 1e6).when(F.col("comp") == "xy", 20.0).otherwise(50.0).alias("lo"), F.when(F.col("site") % 4 == 0, 1e7).otherwise(900.0).alias("hi"))
    return curves.trim(d, k, b)


@query("merge_rows", "site:b comp:s period:d re:d kind:s", "J21", with_(TF) + "SELECT site, comp, period, re, kind FROM tf WHERE rate_hz = 1 AND ((comp = 'xy' AND kind = 'remote') OR (comp = 'yx' AND kind = 'stack'))")
def merge_rows(t):
    d = tf(t).where(F.col("rate_hz") == 1)
    x, y = d.where(F.col("kind") == "remote"), d.where(F.col("kind") == "stack")
    return curves.merge_rows(x, x, y, ["site"])


@query("quadrant_sign", IN + " kind:s n_band:b first:b third:b sign:b", "T6 M5", with_(TF, SCAL, """k AS (SELECT *, row_number() OVER (PARTITION BY site, rate_hz, comp, kind ORDER BY period) - 1 AS k, count(*) OVER (PARTITION BY site, rate_hz, comp, kind) AS n FROM sl WHERE period BETWEEN 30 AND 1000),
p AS (SELECT *, list_contains(list_transform([0, 1, 2, 3, 4, 5], lambda j : CAST(round_even(j * (n - 1) / 5.0, 0) AS BIGINT)), k) AS inn FROM k),
g AS (SELECT site, rate_hz, comp, kind, max(n) AS n_band, count(*) FILTER (WHERE inn AND ph BETWEEN 0 AND 90) AS "first", count(*) FILTER (WHERE inn AND ph BETWEEN -180 AND -90) AS third FROM p GROUP BY ALL)""") + """SELECT *, CASE WHEN n_band >= 6 AND "first" >= 4 THEN 1 WHEN n_band >= 6 AND third >= 4 THEN -1 END AS sign FROM g""")
def quadrant_sign(t):
    return curves.quadrant_sign(tf(t), [*W, "kind"])


@query("splice_period", IN + " a:s b:s t_c:d n_tested:b frac_agree:d", "W19", with_(TF, SCAL, _pts("pt", 10.0, 3000.0), "c AS (SELECT *, (abs(ratio - 1) <= 0.25 AND abs(dphi) <= 8) OR abs(ratio - 1) <= 2 * 0.004 * nb AS ok FROM pt)", "l AS (SELECT *, bool_and(ok) OVER (PARTITION BY site, rate_hz, comp, a, b ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS al FROM c)")
       + "SELECT site, rate_hz, comp, a, b, min(period) FILTER (WHERE al) AS t_c, count(*) AS n_tested, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS frac_agree FROM l GROUP BY ALL")
def splice_period(t):
    return curves.splice_period(pts(t, 10.0, 3000.0), [*W, "a", "b"], 0.25, 8.0, apart=F.col("ratio") - 1, combined=0.004 * F.col("n_b"))


@query("smoothness", IN + " kind:s n_periods:b max_phase_step_deg:d max_phase_step_deg_per_decade:d median_abs_dphi_deg:d", "A19", with_(TF, SCAL, """g AS (SELECT *, log10(period) AS lt, log10(rho) AS lr FROM sl), d AS (SELECT *, ph - lag(ph) OVER w AS dp, lt - lag(lt) OVER w AS hl, lead(lt) OVER w - lt AS hr, lr - lag(lr) OVER w AS fl, lead(lr) OVER w - lr AS fr FROM g WINDOW w AS (PARTITION BY site, rate_hz, comp, kind ORDER BY period)),
e AS (SELECT *, abs(((dp + 180) % 360 + 360) % 360 - 180) AS st, CASE WHEN hl IS NULL THEN fr / hr WHEN hr IS NULL THEN fl / hl ELSE (hl * hl * fr + hr * hr * fl) / (hl * hr * (hl + hr)) END AS gr FROM d)""") + """SELECT site, rate_hz, comp, kind, count(*) AS n_periods, max(st) AS max_phase_step_deg,
  max(st / greatest(hl, 0.05)) AS max_phase_step_deg_per_decade, median(abs(ph - 45 * (1 - gr))) AS median_abs_dphi_deg FROM e GROUP BY ALL""")
def smoothness(t):
    return curves.smoothness(tf(t), [*W, "kind"])


@query("smoothness_jumps", IN + " kind:s n_jumps:b worst_z:d jumps_per_decade:d", "W17 A19")
def smoothness_jumps(t):
    # the residual against a weighted quadratic is tested against numpy's least squares
    return curves.smoothness(tf(t), [*W, "kind"], jump_z=2.0)


# ---------------------------------------------------------------- two rates of one kind

def rates(t):
    """Each kind's 10 Hz curve read on the 1 Hz curve's periods: a = 1 Hz, b = 10 Hz."""
    d = tf(t).withColumn("name", F.format_string("%02d", F.col("rate_hz").cast("int")))
    pairs = curves.pair_list(d, ["site", "comp", "kind"], "name")
    return curves.paired(d, pairs, ["site", "comp", "kind"], "name", "missing")


RATES = (TF, SCAL, "sr AS (SELECT site, CASE kind WHEN 'remote' THEN 1.0 WHEN 'stack' THEN 2.0 ELSE 3.0 END AS rate_hz, comp, CASE rate_hz WHEN 1 THEN '01' ELSE '10' END AS kind, period, rho, ph FROM sl)", _pts("rp", 0.0, 1e9, False, "sr"),
         "rr AS (SELECT site, comp, CASE rate_hz WHEN 1 THEN 'remote' WHEN 2 THEN 'stack' ELSE 'obs' END AS kind, period, ratio, nb FROM rp WHERE ratio IS NOT NULL)")
LV = "{n} AS (SELECT site, comp, kind, CASE WHEN count(*) >= 2 THEN 100 * (median(ratio) - 1) END AS v FROM rr WHERE period BETWEEN {a} AND {b} GROUP BY ALL)"
STEP = (LV.format(n="s1", a=8, b=16), LV.format(n="s2", a=32, b=100), LV.format(n="s3", a=4, b=32), """stp AS (SELECT k.site, k.comp, k.kind, s1.v AS step_below_pct, s2.v AS step_above_pct, s3.v AS level_pct,
  CASE WHEN s2.v IS NULL THEN s1.v WHEN s1.v IS NULL THEN s2.v WHEN abs(s2.v) > abs(s1.v) THEN s2.v ELSE s1.v END AS step_pct FROM (SELECT DISTINCT site, comp, kind FROM rr) k LEFT JOIN s1 USING (site, comp, kind) LEFT JOIN s2 USING (site, comp, kind) LEFT JOIN s3 USING (site, comp, kind))""")


@query("step_at_join", "site:b comp:s kind:s step_below_pct:d step_above_pct:d level_pct:d step_pct:d", "W20 A25", with_(*RATES, *STEP) + "SELECT * FROM stp")
def step_at_join(t):
    return splice.step_at_join(rates(t).where(F.col("ratio").isNotNull()), ["site", "comp", "kind"])


@query("rate_gate", "comp:s n:b rate_pct_median:d rate_pct_worst:d kind_spread_pct:d can_splice:z", "A25", with_(*RATES, *STEP) + """SELECT comp, n, m AS rate_pct_median, w AS rate_pct_worst, s AS kind_spread_pct, abs(m) <= 4 AS can_splice FROM (SELECT comp, count(*) AS n, median(level_pct) AS m, arg_max(level_pct, (round(abs(level_pct), 12), level_pct)) AS w FROM stp WHERE level_pct IS NOT NULL GROUP BY comp)
  JOIN (SELECT comp, median(s) FILTER (WHERE n > 1) AS s FROM (SELECT comp, site, count(*) AS n, max(level_pct) - min(level_pct) AS s FROM stp WHERE level_pct IS NOT NULL GROUP BY ALL) GROUP BY comp) USING (comp)""")
def rate_gate(t):
    lv = splice.level_pct(rates(t).where(F.col("ratio").isNotNull()), ["site", "comp", "kind"], 4.0, 32.0, "rate_pct")
    return splice.rate_gate(lv, ["comp"], "site")


BARS = """br AS (SELECT site, comp, CASE kind WHEN 'remote' THEN 'whole' WHEN 'stack' THEN 'stretch' ELSE 'control' END AS selection, median(rel) AS bar FROM sl WHERE rate_hz = 10 AND period BETWEEN 2 AND 16 GROUP BY ALL),
gt AS (SELECT br.*, c.bar AS control_bar, CASE selection WHEN 'whole' THEN true WHEN 'control' THEN false ELSE coalesce(br.bar <= 0.8 * c.bar AND c.bar > 0, false) END AS eligible,
  CASE WHEN selection IN ('whole', 'control') THEN selection WHEN br.bar IS NULL OR c.bar IS NULL OR c.bar <= 0 THEN 'UNJUDGED' WHEN br.bar <= 0.8 * c.bar THEN 'beats' ELSE 'does not beat' END AS verdict
  FROM br LEFT JOIN (SELECT site, comp, bar FROM br WHERE selection = 'control') c ON c.site = br.site AND c.comp = br.comp)"""


def gate(t):
    d = tf(t).where(F.col("rate_hz") == 10).withColumn("selection", F.when(F.col("kind") == "remote", "whole").when(F.col("kind") == "stack", "stretch").otherwise("control"))
    return splice.control_gate(curves.bar(d, ["site", "comp", "selection"], 2.0, 16.0), ["site", "comp"], "selection")


@query("control_gate", "site:b comp:s selection:s bar:d control_bar:d eligible:z verdict:s", "A26 A24", with_(TF, SCAL, BARS) + "SELECT * FROM gt")
def control_gate(t):
    return gate(t)


@query("splice_choice", "site:b comp:s pick:s why:s", "W20", with_(*RATES, *STEP, """sb AS (SELECT site, comp, kind, median(rel) AS short_bar FROM sl WHERE rate_hz = 10 AND period BETWEEN 2 AND 10 GROUP BY ALL),
c AS (SELECT stp.*, short_bar, site % 5 <> 0 AS passes, kind <> 'obs' AS eligible FROM stp LEFT JOIN sb USING (site, comp, kind)), f AS (SELECT *, passes AND eligible AS o, coalesce(abs(step_pct) <= 2, false) AS st, coalesce(short_bar <= 0.25, false) AS sh, coalesce(abs(level_pct) <= 5, false) AS lv FROM c),
p AS (SELECT site, comp, kind FROM f WHERE o AND st AND sh AND (comp = 'yx' OR lv) QUALIFY row_number() OVER (PARTITION BY site, comp ORDER BY round(CASE comp WHEN 'xy' THEN abs(level_pct) ELSE short_bar END, 12), kind) = 1),
g AS (SELECT site, comp, count(*) FILTER (WHERE passes) AS np, count(*) FILTER (WHERE o) AS n_o, count(*) FILTER (WHERE o AND st) AS ns, count(*) FILTER (WHERE o AND st AND sh) AS n_b FROM f GROUP BY ALL)""") + """SELECT g.site, g.comp, coalesce(p.kind, 'none') AS pick, CASE WHEN p.kind IS NOT NULL THEN 'joined'
  WHEN np = 0 THEN 'no short row passes the response tests' WHEN n_o = 0 THEN 'no row holds the control gate' WHEN ns = 0 THEN 'no row holds the step at the join' WHEN n_b = 0 THEN 'the short-end bar is over the ceiling' ELSE 'no row holds its level' END AS why FROM g LEFT JOIN p USING (site, comp)""")
def splice_choice(t):
    s = splice.step_at_join(rates(t).where(F.col("ratio").isNotNull()), ["site", "comp", "kind"])
    b = curves.bar(tf(t).where(F.col("rate_hz") == 10), ["site", "comp", "kind"], 2.0, 10.0, "short_bar")
    d = s.join(b, ["site", "comp", "kind"], "left").withColumn("passes", F.col("site") % 5 != 0).withColumn("eligible", F.col("kind") != "obs")
    return splice.choose_short(d, ["site"], "kind")


@query("step_and_splice", "site:b comp:s period:d re:d source:s", "W20 J21", with_(TF) + """SELECT site, comp, period, re, 'base' AS source FROM tf WHERE kind = 'remote' AND rate_hz = 1 AND (NOT (comp = 'xy' AND site % 2 = 0) OR period >= 16)
  UNION ALL SELECT site, comp, period, re, 'short' FROM tf WHERE kind = 'remote' AND rate_hz = 10 AND comp = 'xy' AND site % 2 = 0 AND period >= 0.6 AND period < 16""")
def step_and_splice(t):
    d = tf(t).where(F.col("kind") == "remote")
    base, short = d.where(F.col("rate_hz") == 1).drop("rate_hz"), d.where(F.col("rate_hz") == 10).drop("rate_hz")
    picked = base.where((F.col("comp") == "xy") & (F.col("site") % 2 == 0)).select("site", "comp").distinct()
    return splice.splice(base, short, picked, ["site"])


@query("union_grid", "site:b period:d", "U2 W20", with_(TF) + """SELECT site, arg_min(period, (o, period)) AS period FROM (SELECT site, period, 0 AS o FROM tf WHERE rate_hz = 1 AND kind = 'remote' UNION ALL SELECT site, period + 2e-8, 1 FROM tf WHERE rate_hz = 10 AND kind = 'remote' AND period + 2e-8 >= 0.6 AND period + 2e-8 < 16)
  GROUP BY site, round(period, 6)""")
def union_grid(t):
    d = tf(t).where(F.col("kind") == "remote")
    return splice.union_grid(d.where(F.col("rate_hz") == 1), d.where(F.col("rate_hz") == 10).withColumn("period", F.col("period") + 2e-8), ["site"])


@query("unspliced_unchanged", "site:b comp:s n:b n_lost:b worst_relative:d ok:z", "A27", with_(TF) + """SELECT site, comp, count(*) AS n, count(*) FILTER (WHERE site % 2 = 0 AND comp = 'xy' AND period < 16) AS n_lost, 0.0 AS worst_relative, count(*) FILTER (WHERE site % 2 = 0 AND comp = 'xy' AND period < 16) = 0 AS ok
  FROM tf WHERE kind = 'remote' AND rate_hz = 1 GROUP BY ALL""")
def unspliced_unchanged(t):
    base = tf(t).where((F.col("kind") == "remote") & (F.col("rate_hz") == 1)).drop("rate_hz")
    picked = base.where((F.col("comp") == "xy") & (F.col("site") % 2 == 0)).select("site", "comp").distinct()
    out = splice.splice(base, base.limit(0), picked, ["site"])
    return splice.unchanged(base, out, ["site"])


@query("first_delivered", "site:b kind:s comp:s first_period:d n_periods:b", "W20 A16", with_(TF) + "SELECT site, kind, comp, min(period) AS first_period, count(*) AS n_periods FROM tf GROUP BY ALL")
def first_delivered(t):
    return splice.first_delivered(tf(t), ["site", "kind"])


@query("tipper_on_periods", "site:b kind:s rate_hz:d comp:s k:b re:d im:d err:d", "J15", with_(TF, f"""n AS (SELECT {CV}, log10(period) AS lx, re, im, err FROM tf),
g AS (SELECT {CV}, k, CAST(log10(pow(10.0, k / 10.0)) AS DOUBLE) AS x FROM (SELECT DISTINCT {CV} FROM n), ({GRID_SQL})),
j AS (SELECT g.*, a.lx AS ax, b.lx AS bx, a.re + coalesce((b.re - a.re) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS re, a.im + coalesce((b.im - a.im) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS im,
  a.err + coalesce((b.err - a.err) * (x - a.lx) / nullif(b.lx - a.lx, 0), 0) AS err FROM g ASOF LEFT JOIN n a ON {SAME("a")} AND g.x >= a.lx ASOF LEFT JOIN n b ON {SAME("b")} AND g.x <= b.lx)""")
       + f"SELECT {CV}, k, CASE WHEN bx - ax <= 0.3 THEN re END AS re, CASE WHEN bx - ax <= 0.3 THEN im END AS im, CASE WHEN bx - ax <= 0.3 THEN err END AS err FROM j")
def tipper_on_periods(t):
    return curves.tipper_on_periods(*on_grid(t), ["site", "kind", "rate_hz"])
