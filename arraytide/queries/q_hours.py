"""Hour scores, daily lines, member lags and the clock test, on the daily record of the regions with its gaps."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions, hours, lags
from .bind import RAX, REC, RGN, SCORED, rax, scored, with_
from .registry import query


@query("hour_scores", "site:b hour:b coh_xy:d coh_yx:d score:d", "X2", with_(REC, RGN, RAX, SCORED) + """SELECT site, i AS hour, coh_xy, coh_yx,
  round((coalesce(coh_xy, 0) + coalesce(coh_yx, 0)) / nullif((coh_xy IS NOT NULL)::INT + (coh_yx IS NOT NULL)::INT, 0) + 2e-10, 6) AS score FROM sc""")
def hour_scores(t):
    return scored(t)


# 64 days make a day of the table, segments are 16 days long; gaps are bridged inside a day
BRIDGED = """last_value(CASE WHEN x IS NOT NULL THEN p END IGNORE NULLS) OVER a AS pp, last_value(x IGNORE NULLS) OVER a AS pv,
  first_value(CASE WHEN x IS NOT NULL THEN p END IGNORE NULLS) OVER z AS np, first_value(x IGNORE NULLS) OVER z AS nv"""
LINE = "CASE WHEN pp IS NULL THEN nv WHEN np IS NULL OR np = pp THEN pv ELSE pv + (nv - pv) * (p - pp) / CAST(np - pp AS DOUBLE) END"
DAYS = f"""db AS (SELECT site, i // 64 AS day, i - min(i) OVER (PARTITION BY site, i // 64) AS p, unnest(['ex', 'ey', 'hx', 'hy']) AS chan, unnest([ex, ey, hx, hy]) AS x FROM rax),
dn AS (SELECT site, day, chan, count(*) AS n, count(x) AS k FROM db GROUP BY ALL HAVING count(*) >= 16),
dd AS MATERIALIZED (SELECT site, day, min(n) AS n, bool_and(k >= 16 AND k >= 0.8 * n) AS fine FROM dn GROUP BY ALL),
df AS (SELECT db.*, {BRIDGED} FROM db JOIN dd USING (site, day) WHERE fine
  WINDOW a AS (PARTITION BY site, day, chan ORDER BY p ROWS UNBOUNDED PRECEDING), z AS (PARTITION BY site, day, chan ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
dx AS MATERIALIZED (SELECT site, day, chan, p, {LINE} AS x FROM df),
ds AS (SELECT site, day, stddev_pop(x) FILTER (WHERE chan = 'ex') AS std_ex, stddev_pop(x) FILTER (WHERE chan = 'ey') AS std_ey FROM dx GROUP BY ALL),
dg AS (SELECT dx.site, dx.day, chan, s, p - 8 * s AS q, x FROM dx JOIN dd USING (site, day), (SELECT unnest(range(7)) AS s) WHERE p BETWEEN 8 * s AND 8 * s + 15 AND 8 * s + 16 <= n),
dm AS (SELECT site, day, s, chan, avg(x) AS m FROM dg GROUP BY ALL),
dz AS MATERIALIZED (SELECT dg.site, dg.day, dg.s, dg.chan, f, sum((0.5 - 0.5 * cos(2 * pi() * q / 16.0)) * (x - m) * cos(2 * pi() * f * q / 16.0)) AS re,
  -sum((0.5 - 0.5 * cos(2 * pi() * q / 16.0)) * (x - m) * sin(2 * pi() * f * q / 16.0)) AS im FROM dg JOIN dm USING (site, day, s, chan), (SELECT unnest(range(1, 7)) AS f) GROUP BY ALL),
dc AS (SELECT a.site, a.day, a.chan || b.chan AS k, a.f, (pow(sum(a.re * b.re + a.im * b.im), 2) + pow(sum(a.im * b.re - a.re * b.im), 2)) / nullif(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im), 0) AS g
  FROM dz a JOIN dz b ON a.site = b.site AND a.day = b.day AND a.s = b.s AND a.f = b.f AND a.chan || b.chan IN ('exhy', 'eyhx', 'exey') GROUP BY ALL),
dv AS (SELECT site, day, median(g) FILTER (WHERE k = 'exhy') AS xh, median(g) FILTER (WHERE k = 'eyhx') AS yh, median(g) FILTER (WHERE k = 'exey') AS xy FROM dc GROUP BY ALL),
ln AS MATERIALIZED (SELECT site, day, n, round(xh + 2e-10, 3) AS coh_ex_hy, round(yh + 2e-10, 3) AS coh_ey_hx, round(xy + 2e-10, 3) AS coh_ex_ey, round(std_ex + 2e-10, 3) AS std_ex, round(std_ey + 2e-10, 3) AS std_ey
  FROM dd LEFT JOIN ds USING (site, day) LEFT JOIN dv USING (site, day)),
lt AS (SELECT site, 0.2 * median(std_ex) AS dx_, 0.2 * median(std_ey) AS dy_ FROM ln GROUP BY site),
st AS (SELECT ln.*, CASE WHEN std_ex IS NULL THEN 'gap' WHEN std_ex < dx_ THEN 'dead' WHEN coh_ex_hy >= 0.4 AND coh_ex_ey < 0.5 THEN 'sound' WHEN coh_ex_ey >= 0.6 AND coh_ex_hy < 0.3 THEN 'common' ELSE 'weak' END AS ex_state,
  CASE WHEN std_ey IS NULL THEN 'gap' WHEN std_ey < dy_ THEN 'dead' WHEN coh_ey_hx >= 0.4 AND coh_ex_ey < 0.5 THEN 'sound' WHEN coh_ex_ey >= 0.6 AND coh_ey_hx < 0.3 THEN 'common' ELSE 'weak' END AS ey_state FROM ln JOIN lt USING (site))"""


def lines(t):
    return hours.daily_lines(rax(t), ["site"], "i", 64, 16, 8, (2.5, 20.0), highpass_s=None, min_day=16)


@query("daily_lines", "site:b day:b n:b coh_ex_hy:d coh_ey_hx:d coh_ex_ey:d std_ex:d std_ey:d", "X2 X8", with_(REC, RGN, RAX, DAYS) + "SELECT * FROM ln")
def daily_lines(t):
    return lines(t)


@query("daily_states", "site:b day:b ex_state:s ey_state:s", "M5 X2", with_(REC, RGN, RAX, DAYS) + "SELECT site, day, ex_state, ey_state FROM st")
def daily_states(t):
    return decisions.line_states(lines(t), ["site"], {"ex": "coh_ex_hy", "ey": "coh_ey_hx"})


# 32 days make a day of the clock test, with 16 more on either side; the reference of a region is the next one
CLOCK = f"""cp AS (SELECT r_regionkey AS site, r_regionkey + 1 AS ref FROM region),
cw AS (SELECT site, i // 32 AS day FROM rax GROUP BY ALL HAVING count(*) = 32),
co AS MATERIALIZED (SELECT cp.site, ref, w.day FROM cp JOIN cw w ON w.site = cp.site WHERE (SELECT count(*) FROM cw r WHERE r.site = ref AND r.day BETWEEN w.day - 1 AND w.day + 1) = 3),
cl AS (SELECT co.site, ref, day, 'x' AS side, i - day * 32 AS p, hx AS x FROM co JOIN rax ON rax.site = co.site AND i // 32 = day
  UNION ALL SELECT co.site, ref, day, 'y', i - day * 32 + 16, hx FROM co JOIN rax ON rax.site = ref AND i BETWEEN day * 32 - 16 AND day * 32 + 47),
ck AS (SELECT site, day FROM (SELECT site, day, side, count(x) AS k, count(*) AS n FROM cl GROUP BY ALL) GROUP BY ALL HAVING bool_and(k >= 16 AND k >= 0.8 * n)),
cf AS (SELECT cl.*, {BRIDGED} FROM cl JOIN ck USING (site, day)
  WINDOW a AS (PARTITION BY site, day, side ORDER BY p ROWS UNBOUNDED PRECEDING), z AS (PARTITION BY site, day, side ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
cb AS (SELECT site, ref, day, side, p, {LINE} AS v FROM cf),
cv AS MATERIALIZED (SELECT *, v - avg(v) OVER (PARTITION BY site, day, side) AS x FROM cb),
cs AS (SELECT site, day, stddev_pop(x) FILTER (WHERE side = 'x') AS sx, stddev_pop(x) FILTER (WHERE side = 'y' AND p BETWEEN 16 AND 47) AS sy FROM cv GROUP BY ALL),
cc AS MATERIALIZED (SELECT a.site, a.ref, a.day, b.p - a.p AS k, sum(a.x * b.x) / (32 * min(sx) * min(sy) + 1e-12) AS c FROM cv a JOIN cv b ON a.site = b.site AND a.day = b.day AND a.side = 'x' AND b.side = 'y' AND b.p - a.p BETWEEN 0 AND 32
  JOIN cs ON cs.site = a.site AND cs.day = a.day GROUP BY ALL),
cm AS (SELECT site, ref, day, k, c, median(abs(c)) OVER (PARTITION BY site, day) AS floor, row_number() OVER (PARTITION BY site, day ORDER BY c DESC, k) AS rk FROM cc),
ct AS (SELECT m.*, u.c AS c0, v.c AS c2 FROM cm m LEFT JOIN cc u ON u.site = m.site AND u.day = m.day AND u.k = m.k - 1 LEFT JOIN cc v ON v.site = m.site AND v.day = m.day AND v.k = m.k + 1 WHERE rk = 1),
days AS (SELECT site, ref, day, k - 16 + CASE WHEN c0 IS NULL OR c2 IS NULL OR c0 - 2 * c + c2 = 0 THEN 0 ELSE least(greatest(0.5 * (c0 - c2) / (c0 - 2 * c + c2), -1), 1) END AS lag_s, c AS r, c / floor AS ratio, abs(k - 16) >= 0.95 * 16 AS edge FROM ct)"""
FIELD = """fm AS (SELECT site, median(sqrt(hx * hx + hy * hy + hz * hz)) * (0.75 + site / 8.0) AS model_f FROM rax GROUP BY site),
fr AS (SELECT rax.site, i // 32 AS day, CASE WHEN count(hx) >= 24 THEN median(sqrt(hx * hx + hy * hy + hz * hz)) / min(model_f) END AS f_ratio FROM rax JOIN fm ON fm.site = rax.site GROUP BY ALL)"""


def following(t):
    k = F.col("r_regionkey").cast("bigint")
    return t.region.select(k.alias("site"), (k + 1).alias("ref"))


def model(t):
    f = F.sqrt(F.col("hx") ** 2 + F.col("hy") ** 2 + F.col("hz") ** 2)
    return rax(t).groupBy("site").agg((F.median(f) * (0.75 + F.first("site") / 8.0)).alias("model_f"))


HOW = {"day": 32, "halo": 16, "band": None}


@query("clock_days", "site:b ref:b day:b lag_s:d r:d ratio:d edge:z", "X7", with_(REC, RGN, RAX, CLOCK) + "SELECT * FROM days")
def clock_days(t):
    return lags.clock_days(rax(t), following(t), "site", "i", **HOW)


@query("daily_field", "site:b day:b f_ratio:d", "X7", with_(REC, RGN, RAX, FIELD) + "SELECT * FROM fr")
def daily_field(t):
    return lags.daily_field(rax(t), ["site"], "i", model(t), 32, 24)


@query("clock_test", "site:b n_offered:b n_days:b judged:z median_lag_s:d ok:z", "X7", with_(REC, RGN, RAX, CLOCK, FIELD, """cd AS (SELECT days.*, coalesce(abs(f_ratio - 1) < 0.2 AND r >= 0.5 AND ratio >= 1.5 AND NOT edge, false) AS counted FROM days LEFT JOIN fr USING (site, day)),
cg AS (SELECT site, count(*) AS n_offered, count(*) FILTER (WHERE counted) AS n_days, median(lag_s) FILTER (WHERE counted) AS m FROM cd GROUP BY site)""")
       + "SELECT site, n_offered, n_days, n_days >= 3 AS judged, CASE WHEN n_days >= 3 THEN m END AS median_lag_s, coalesce(n_days >= 3 AND abs(m) <= 10, false) AS ok FROM cg")
def clock_test(t):
    return lags.clock_test(rax(t), following(t), model(t), "site", "i", 3, least=24, **HOW)


@query("xcorr_lag", "a:b b:b lag_s:d spread:d n_windows:b win:b note:s", "X6")
def xcorr_lag(t):
    p = following(t).withColumnsRenamed({"site": "a", "ref": "b"})
    return lags.member_lags(rax(t), p, "site", "i", win=96, fallback=64, max_lag=5, short=(1 / 8.0, 1 / 3.0), long=(1 / 24.0, 1 / 8.0))
