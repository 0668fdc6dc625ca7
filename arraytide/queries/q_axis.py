"""Placement, gaps, runs, masks and the stretch rule."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import axis, intervals, islands, stretches
from .bind import CH, DAX, DAY_BLOCK, EV, HOUR, HS, RAX, REC, RGN, SCORED, dax, ev, hs, rec, rgn, sc, with_
from .registry import query

HB = 96          # hourly block: small, so that the local tables cross many block edges


@query("place_on_axis", "site:b i:b v:d n_read:b", "J1 D1 S16",
       with_(EV, HS) + """SELECT b.site, b.i, hs.v, coalesce(hs.n_read, 0) AS n_read FROM
  (SELECT site, unnest(generate_series(min(i), max(i))) AS i FROM hs GROUP BY site) b
  LEFT JOIN hs ON hs.site = b.site AND hs.i = b.i""")
def place_on_axis(t):
    d = axis.densify(hs(t), ["site"], "i", ["v", "n_read"], block=HB)
    return d.withColumn("n_read", F.coalesce("n_read", F.lit(0)))


@query("reconcile_record", "site:b samples_read:b samples_placed:b overlap_samples:b unplaced_samples:b verdict:s",
       "A2 J1", with_(EV, """a AS (SELECT site, max(sec // 3600) AS last_i FROM ev GROUP BY site),
p AS (SELECT ev.site, sec // 3600 AS i, count(*) AS n, count(*) FILTER (WHERE sec // 3600 < last_i) AS n_in
  FROM ev JOIN a ON a.site = ev.site GROUP BY 1, 2)""") + """SELECT *, CASE WHEN samples_placed = samples_read AND overlap_samples = 0
  AND unplaced_samples = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT site, sum(n) AS samples_read, sum(n_in) AS samples_placed,
  sum(greatest(n_in - 1, 0)) AS overlap_samples, sum(n - n_in) AS unplaced_samples FROM p GROUP BY site)""")
def reconcile_record(t):
    # the axis ends one hour before the last event, so every record has something that falls outside it
    d = ev(t).withColumn("i", F.floor(F.col("sec") / 3600))
    ends = d.groupBy("site").agg(F.max("i").alias("last_i"))
    return axis.reconcile(d.join(ends, "site"), ["site"], "i", F.col("i") < F.col("last_i"))


@query("gap_stats", "site:b n:b nan_fraction:d n_gaps:b longest_gap:b", "A3 W4",
       with_(EV, HS, """g AS (SELECT site, i, lead(i) OVER (PARTITION BY site ORDER BY i) - i - 1 AS gap FROM hs)""")
       + """SELECT site, max(i) - min(i) + 1 AS n, 1 - count(*) / CAST(max(i) - min(i) + 1 AS DOUBLE) AS nan_fraction,
  count(*) FILTER (WHERE gap > 0) AS n_gaps, coalesce(max(gap) FILTER (WHERE gap > 0), 0) AS longest_gap FROM g GROUP BY site""")
def gap_stats(t):
    return islands.gap_stats(hs(t), ["site"], "i", block=HB)


RUNS_SQL = """r AS (SELECT site, min(i) AS run_start, max(i) AS run_end, count(*) AS run_len FROM
  (SELECT site, i, i - row_number() OVER (PARTITION BY site ORDER BY i) AS g FROM {src}) GROUP BY site, g)"""


@query("keep_runs", "site:b run_start:b run_end:b run_len:b", "W4 U4",
       with_(EV, HS, RUNS_SQL.format(src="hs")) + "SELECT * FROM r WHERE run_len >= 2")
def keep_runs(t):
    return islands.runs(hs(t), ["site"], "i", min_len=2, block=HB)


@query("floor_dropped", "site:b kept:b dropped:b n_runs:b dropped_frac:d", "A20",
       with_(EV, HS, RUNS_SQL.format(src="hs")) + """SELECT site, sum(run_len) AS kept,
  sum(CASE WHEN run_len < 2 THEN run_len ELSE 0 END) AS dropped, count(*) FILTER (WHERE run_len >= 2) AS n_runs,
  sum(CASE WHEN run_len < 2 THEN run_len ELSE 0 END) / CAST(max(run_end) - min(run_start) + 1 AS DOUBLE) AS dropped_frac
  FROM r GROUP BY site""")
def floor_dropped(t):
    k = hs(t)
    ext = axis.extent(k, ["site"], "i")
    return (islands.floor_dropped(k, ["site"], "i", 2, block=HB).join(ext, "site")
            .withColumn("dropped_frac", F.col("dropped") / F.col("n")))


@query("whole_blocks", "site:b slot:b n:b", "W10 D2",
       with_(REC, DAX) + """SELECT site, i // 7 AS slot, count(*) AS n FROM dax WHERE hx IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 7""")
def whole_blocks(t):
    return axis.whole_blocks(dax(t), ["site"], "i", 7, ["hx", "hy"])


@query("block_stats", "site:b slot:b mean:d low:d high:d n:b", "A18",
       with_(REC) + """SELECT site, i // 30 AS slot, avg(hx) AS mean, min(hx) AS low, max(hx) AS high, count(hx) AS n FROM rec GROUP BY 1, 2""")
def block_stats(t):
    return axis.block_stats(rec(t), ["site"], "i", "hx", 30)


@query("unit_gains", "site:b i:b hx:d hz:d ex:d ey:d", "P5",
       with_(REC) + """SELECT site, i, hx / 142.857 AS hx, hz / (142.857 * 0.4) AS hz,
  CASE WHEN site % 5 = 0 THEN ex ELSE ex / ((40.0 + site) * 10.0) END AS ex, ey / 500.0 AS ey FROM rec""")
def unit_gains(t):
    d = rec(t).withColumn("dipole_n_m", F.when(F.col("site") % 5 != 0, 40.0 + F.col("site"))).withColumn(
        "dipole_e_m", F.lit(50.0))
    return axis.unit_gains(d)


@query("on_other_grid", "site:b i:b hx:d hy:d", "J2 J18 S17",
       with_(REC, DAX) + """SELECT a.site, a.i, b.hx, b.hy FROM dax a LEFT JOIN
  (SELECT site - 1 AS site, i + 3 AS i, hx, hy FROM dax WHERE site > 0) b ON a.site = b.site AND a.i = b.i""")
def on_other_grid(t):
    d = dax(t)
    lender = d.where(F.col("site") > 0).withColumn("site", F.col("site") - 1)
    return axis.on_grid(d, lender, ["site"], "i", ["hx", "hy"], 3)


@query("zero_order_hold", "site:b i:b hx:d", "J11",
       with_(REC) + """SELECT site, i * 4 + k AS i, hx FROM rec, (SELECT unnest([0, 1, 2, 3]) AS k)""")
def zero_order_hold(t):
    return axis.zero_order_hold(rec(t).select("site", "i", "hx"), ["site"], "i", 4)


ERR = """er AS (SELECT site, sec - 600 AS a, sec + 600 AS b FROM ev WHERE etype = 'error')"""


@query("interval_mask", "site:b event_id:b sec:b", "J6 P9 U5",
       with_(EV, ERR) + """SELECT site, event_id, sec FROM ev WHERE NOT EXISTS
  (SELECT 1 FROM er WHERE er.site = ev.site AND ev.sec >= er.a AND ev.sec < er.b)""")
def interval_mask(t):
    e = ev(t)
    bad = e.where(F.col("etype") == "error").select("site", (F.col("sec") - 600).alias("a"), (F.col("sec") + 600).alias("b"))
    return intervals.in_intervals(e, bad, ["site"], "sec", "a", "b")


@query("merged_intervals", "site:b a:b b:b n:b", "U4 W4",
       with_(EV, """er AS (SELECT site, sec - 7200 AS a, sec + 7200 AS b FROM ev WHERE etype = 'error'),
m AS (SELECT *, max(b) OVER (PARTITION BY site ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM er),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY a, b) AS isl FROM m)""")
       + "SELECT site, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY site, isl")
def merged_intervals(t):
    e = ev(t).where(F.col("etype") == "error").select(
        "site", (F.col("sec") - 7200).alias("a"), (F.col("sec") + 7200).alias("b"))
    return islands.merge_intervals(e, ["site"], "a", "b", block=43200, extra=[F.count(F.lit(1)).alias("n")])


@query("keep_fractions", "site:b n:b finite_frac:d kept_frac:d transient_dropped_frac:d reference_coverage_dropped_frac:d selection_dropped_frac:d mask_dropped_frac:d",
       "P10 D4", with_(EV, """iv AS (SELECT site, sec - 600 AS a, sec + 600 AS b FROM ev WHERE etype = 'error'),
m AS (SELECT ev.*, value < 200 AS fin, EXISTS (SELECT 1 FROM iv WHERE iv.site = ev.site AND ev.sec >= iv.a AND ev.sec < iv.b) AS hit,
  k >= 10 AS cov, sec % 86400 < 64800 AS sel FROM ev)""") + """SELECT site, n, finite_frac, kept_frac, finite_frac - mm AS transient_dropped_frac,
  mm - rr AS reference_coverage_dropped_frac, rr - kept_frac AS selection_dropped_frac, 1 - kept_frac AS mask_dropped_frac FROM
  (SELECT site, count(*) AS n, avg(CASE WHEN fin THEN 1.0 ELSE 0.0 END) AS finite_frac, avg(CASE WHEN fin AND NOT hit THEN 1.0 ELSE 0.0 END) AS mm,
  avg(CASE WHEN fin AND NOT hit AND cov THEN 1.0 ELSE 0.0 END) AS rr, avg(CASE WHEN fin AND NOT hit AND cov AND sel THEN 1.0 ELSE 0.0 END) AS kept_frac FROM m GROUP BY site)""")
def keep_fractions(t):
    e = ev(t)
    bad = e.where(F.col("etype") == "error").select("site", (F.col("sec") - 600).alias("a"), (F.col("sec") + 600).alias("b"))
    d = intervals.mark(e, bad, ["site"], "sec", "a", "b", "hit")
    return intervals.keep_fractions(d, ["site"], F.col("value") < 200, F.col("hit"), F.col("k") >= 10,
                                    F.col("sec") % 86400 < 64800)


@query("half_masks", "site:b half:s n:b", "P9", with_(EV, HS) + """SELECT site, half, count(*) AS n FROM
  (SELECT site, CASE WHEN i - min(i) OVER w < (max(i) OVER w - min(i) OVER w + 1) // 2 THEN 'half1' ELSE 'half2' END AS half
   FROM hs WINDOW w AS (PARTITION BY site)) GROUP BY 1, 2""")
def half_masks(t):
    k = hs(t)
    d = k.join(axis.extent(k, ["site"], "i"), "site")
    return (d.withColumn("half", intervals.half_of(F.col("i"), F.col("t0"), F.col("n"))).groupBy("site", "half")
            .agg(F.count(F.lit(1)).alias("n")))


STRETCH = """f AS (SELECT site, i, (coh_xy + coh_yx) / 2 AS s, coalesce(coh_xy > 0.3 AND coh_yx > 0.3, false) AS ok, coh_xy, coh_yx FROM sc),
cnt AS (SELECT site, count(*) FILTER (WHERE coh_xy IS NOT NULL OR coh_yx IS NOT NULL) AS n_scored, count(*) FILTER (WHERE ok) AS n_above FROM f GROUP BY site),
r AS (SELECT site, min(i) AS a, max(i) AS z, count(*) AS len FROM (SELECT site, i, i - row_number() OVER (PARTITION BY site ORDER BY i) AS g
  FROM f WHERE ok) GROUP BY site, g),
b AS (SELECT *, count(*) OVER (PARTITION BY site) AS n_runs FROM r QUALIFY row_number() OVER (PARTITION BY site ORDER BY len DESC, a) = 1),
w AS (SELECT f.site, f.i, avg(f.s) OVER (PARTITION BY f.site ORDER BY f.i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS m, b.z
  FROM f JOIN b ON b.site = f.site AND f.i BETWEEN b.a AND b.z),
p AS (SELECT site, i, m FROM w WHERE i + 5 <= z QUALIFY row_number() OVER (PARTITION BY site ORDER BY round(m, 12) DESC, i) = 1),
mean AS (SELECT f.site, avg(f.s) AS m FROM f JOIN b ON b.site = f.site AND f.i BETWEEN b.a AND b.z GROUP BY f.site),
st AS (SELECT cnt.site, n_scored, n_above, coalesce(n_runs, 0) AS n_runs, coalesce(len > 6, false) AS cut,
  CASE WHEN len > 6 THEN p.i ELSE b.a END AS t_start, CASE WHEN len > 6 THEN p.i + 6 ELSE b.z + 1 END AS t_end,
  CASE WHEN len > 6 THEN p.m ELSE mean.m END AS mean_score
  FROM cnt LEFT JOIN b ON b.site = cnt.site LEFT JOIN p ON p.site = cnt.site LEFT JOIN mean ON mean.site = cnt.site)"""

BEST_COLS = "site:b n_scored:b n_above:b n_runs:b cut:z t_start:b t_end:b hours:b mean_score:d reason:s"


def best(t):
    return stretches.longest_stretch(sc(t), ["site"], "i", ["coh_xy", "coh_yx"], coh_min=0.3, max_hours=6, block=32)


@query("runs_above", "site:b run_start:b run_end:b run_len:b", "W4",
       with_(REC, RGN, RAX, SCORED) + """SELECT site, min(i) AS run_start, max(i) AS run_end, count(*) AS run_len FROM (SELECT site, i,
  i - row_number() OVER (PARTITION BY site ORDER BY i) AS g FROM sc WHERE coh_xy > 0.5 AND coh_yx > 0.5) GROUP BY site, g""")
def runs_above(t):
    return stretches.runs_above(sc(t), ["site"], "i", ["coh_xy", "coh_yx"], block=32)


@query("best_stretch", BEST_COLS, "W5 D12",
       with_(REC, RGN, RAX, SCORED, STRETCH) + """SELECT *, coalesce(t_end - t_start, 0) AS hours, CASE WHEN t_start IS NULL THEN
  'no hour reads above the threshold on every named line' WHEN cut THEN 'the best hours inside the longest contiguous run'
  ELSE 'the longest contiguous run' END AS reason FROM st""")
def best_stretch(t):
    return best(t)


CONTROL = """sp0 AS (SELECT site, min(i) AS lo, max(i) + 1 AS hi FROM sc GROUP BY site),
c AS (SELECT st.site, t_start, t_end, t_end - t_start AS hours, hi, unnest(generate_series(lo, greatest(lo, hi - (t_end - t_start)))) AS t
  FROM st JOIN sp0 ON sp0.site = st.site WHERE t_start IS NOT NULL),
fr AS (SELECT *, t + hours <= hi AND (t + hours <= t_start OR t >= t_end) AS free FROM c),
ct AS (SELECT site, hours, arg_min(t, md5('7|' || site || '|' || t)) FILTER (WHERE free) AS t, count(*) FILTER (WHERE free) AS n_free FROM fr GROUP BY site, hours)"""


def control(t, b):
    spans = sc(t).groupBy("site").agg(F.min("i").alias("t0"), (F.max("i") + 1).alias("t1"))
    return stretches.control_stretch(b, spans, ["site"], seed=7)


@query("control_stretch", "site:b t_start:b t_end:b hours:b n_free:b", "W21",
       with_(REC, RGN, RAX, SCORED, STRETCH, CONTROL) + """SELECT site, t AS t_start, t + hours AS t_end, CASE WHEN n_free > 0 THEN hours ELSE 0 END AS hours, n_free FROM ct""")
def control_stretch(t):
    return control(t, best(t))


@query("stretch_verdict", "site:b rule:s t_start:b t_end:b n_runs_kept:b kept_samples:b refused:s", "T7 A29",
       with_(REC, RGN, RAX, SCORED, STRETCH, CONTROL, """sel AS (SELECT site, 'stretch' AS rule, t_start, t_end FROM st
  UNION ALL SELECT site, 'control' AS rule, t AS t_start, t + hours AS t_end FROM ct),
kept AS (SELECT site, i AS h FROM rgn WHERE hz > ex),
ki AS (SELECT sel.site, sel.rule, h FROM sel JOIN kept ON kept.site = sel.site AND h >= t_start * 32 AND h < t_end * 32),
kr AS (SELECT site, rule, count(*) AS len FROM (SELECT *, h - row_number() OVER (PARTITION BY site, rule ORDER BY h) AS g FROM ki) GROUP BY site, rule, g HAVING count(*) >= 2),
ka AS (SELECT site, rule, count(*) AS n_runs_kept, sum(len) AS kept_samples FROM kr GROUP BY 1, 2)""")
       + """SELECT sel.site, sel.rule, t_start, t_end, coalesce(n_runs_kept, 0) AS n_runs_kept, coalesce(kept_samples, 0) AS kept_samples,
  CASE WHEN t_start IS NULL THEN 'no stretch' WHEN coalesce(n_runs_kept, 0) = 0 THEN 'the mask leaves no whole run inside the stretch' ELSE '' END AS refused
  FROM sel LEFT JOIN ka ON ka.site = sel.site AND ka.rule = sel.rule""")
def stretch_verdict(t):
    from ..plans.selection import select_stretches
    kept = rgn(t).where(F.col("hz") > F.col("ex")).select("site", F.col("i").alias("h"))
    return select_stretches(sc(t), kept, ["site"], "i", ["coh_xy", "coh_yx"], "h", coh_min=0.3, max_hours=6, seed=7,
                            scale=HOUR, min_run=2, block=32)


@query("quiet_window", "site:b slot:b std:d n_whole:b", "W22", with_(REC, DAX) + """SELECT site, slot, std, n_whole FROM (SELECT *, count(*) OVER (PARTITION BY site) AS n_whole,
  row_number() OVER (PARTITION BY site ORDER BY round(std, 9), slot) AS rn FROM (SELECT site, i // 6 AS slot, stddev_pop(hx) AS std FROM dax
  WHERE hx IS NOT NULL AND ex IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 6)) WHERE rn = 1""")
def quiet_window(t):
    return stretches.quiet_window(dax(t), ["site"], "i", "hx", ["ex"], 6)


@query("spread_windows", "site:b w_start:b w_end:b", "W24", with_(REC, """r AS (SELECT site, min(i) AS a, count(*) AS len FROM
  (SELECT site, i, i - row_number() OVER (PARTITION BY site ORDER BY i) AS g FROM rec) GROUP BY site, g),
w AS (SELECT site, a + 4 * j AS w_start, a + 4 * j + 4 AS w_end FROM (SELECT site, a, unnest(generate_series(0, len // 4 - 1)) AS j FROM r WHERE len >= 4)),
n AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY w_start) - 1 AS k, count(*) OVER (PARTITION BY site) AS n FROM w)""")
       + """SELECT site, w_start, w_end FROM n WHERE n <= 8 OR EXISTS (SELECT 1 FROM (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS j)
  WHERE round_even(j * (n - 1) / 7.0, 0) = k)""")
def spread_windows(t):
    w = stretches.run_windows(islands.runs(rec(t), ["site"], "i", block=DAY_BLOCK), ["site"], 4)
    return stretches.spread_windows(w, ["site"], "w_start", 8)
