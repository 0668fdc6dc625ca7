"""Coherence maps by levels, spectra of longest runs and responses with errors, on the daily record of every region as samples of 1 Hz."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import estimate, maps, spectral
from .bind import RAX, REC, RGN, rax, with_
from .registry import query

# three levels: segments of 8, 16 and 32 days in windows of 32, 48 and 96 days; days out of service are 97 apart
LADDER = dict(win_s=32, step_s=16, shortest_s=2.0, longest_s=32.0, first_segments=4, later_segments=3, factor=2)
MAP = """lv AS (SELECT * FROM (VALUES (0, 8, 32, 16, 2.0, 8.0, 5), (1, 16, 48, 16, 8.0, 16.0, 2), (2, 32, 96, 16, 16.0, 32.0, 2)) AS t(level, n, w, st, lo, hi, nb)),
lw AS (SELECT site, level, n, w, lo, hi, nb, unnest(range(CAST(ceil(a / st) AS BIGINT), CAST(floor((b + 1 - w) / st) AS BIGINT) + 1)) AS win FROM (SELECT site, min(i) AS a, max(i) AS b FROM rax GROUP BY site), lv),
pr AS (SELECT * FROM (VALUES ('hx_ey', 'hx', 'ey'), ('hy_ex', 'hy', 'ex'), ('hx_hy', 'hx', 'hy'), ('ex_ey', 'ex', 'ey')) AS t(pair, ca, cb)),
wd AS MATERIALIZED (SELECT lw.site, level, n, w, win, i - win * 16 AS q, unnest(['hx', 'hy', 'ex', 'ey']) AS chan, unnest([hx, hy, ex, ey]) AS x FROM lw JOIN rax ON rax.site = lw.site AND i BETWEEN win * 16 AND win * 16 + w - 1),
wh AS (SELECT site, level, win, chan FROM wd GROUP BY site, level, win, chan, w HAVING count(x) = w),
sg AS (SELECT site, level, n, win, chan, s, q - s * (n // 2) AS p, x FROM wd JOIN wh USING (site, level, win, chan), (SELECT unnest(range(7)) AS s) WHERE s <= (w - n) // (n // 2) AND q - s * (n // 2) BETWEEN 0 AND n - 1),
sm AS (SELECT site, level, win, chan, s, avg(x) AS m FROM sg GROUP BY ALL),
ft AS MATERIALIZED (SELECT sg.site, sg.level, sg.win, sg.chan, sg.s, f, sum((0.5 - 0.5 * cos(2 * pi() * p / n)) * (x - m) * cos(2 * pi() * f * p / n)) AS re, -sum((0.5 - 0.5 * cos(2 * pi() * p / n)) * (x - m) * sin(2 * pi() * f * p / n)) AS im
  FROM sg JOIN sm USING (site, level, win, chan, s), (SELECT unnest(range(1, 17)) AS f) WHERE f <= n // 2 GROUP BY ALL),
cg AS (SELECT a.site, a.level, a.win, pair, a.f, (pow(sum(a.re * b.re + a.im * b.im), 2) + pow(sum(a.im * b.re - a.re * b.im), 2)) / nullif(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im), 0) AS g
  FROM pr JOIN ft a ON a.chan = ca JOIN ft b ON b.chan = cb AND a.site = b.site AND a.level = b.level AND a.win = b.win AND a.s = b.s AND a.f = b.f GROUP BY ALL),
hb AS (SELECT level, f, lo, hi, nb, CAST(floor(ln(n / CAST(f AS DOUBLE) / lo) / ln(hi / lo) * nb + 1e-9) AS BIGINT) AS bin FROM lv, (SELECT unnest(range(1, 17)) AS f) WHERE f <= n // 2),
bv AS (SELECT site, level, win, pair, bin, avg(g) AS coh FROM cg JOIN hb USING (level, f) WHERE bin BETWEEN 0 AND nb - 1 GROUP BY ALL),
cm AS (SELECT lw.site, pair, lw.level, win, win * 16 + w / 2.0 AS t_s, bin, lw.lo * pow(lw.hi / lw.lo, (bin + 0.5) / lw.nb) AS period_s, coh
  FROM (SELECT * FROM lw JOIN (SELECT DISTINCT level, bin FROM hb WHERE bin BETWEEN 0 AND nb - 1) USING (level) CROSS JOIN pr) lw LEFT JOIN bv USING (site, level, win, pair, bin))"""


def cmap(t):
    return maps.coherence_map(rax(t).withColumn("fs_hz", F.lit(1.0)), ["site"], "i", **LADDER)


@query("coherence_map", "site:b pair:s level:b win:b t_s:d bin:b period_s:d coh:d", "W13", with_(REC, RGN, RAX, MAP) + "SELECT * FROM cm")
def coherence_map(t):
    return cmap(t)


BAND = """bl AS (SELECT site, pair, band, level, win, avg(coh) AS v FROM cm JOIN (VALUES ('short', 2.5, 8.0), ('long', 6.0, 40.0)) AS t(band, b0, b1) ON period_s BETWEEN b0 AND b1 GROUP BY ALL),
tm AS MATERIALIZED (SELECT DISTINCT site, pair, level, win, t_s FROM cm),
nw AS (SELECT a.site, a.pair, a.win AS base, a.t_s, b.level, coalesce(min(b.win) FILTER (WHERE b.t_s >= a.t_s), max(b.win)) AS win FROM tm a JOIN tm b ON a.site = b.site AND a.pair = b.pair WHERE a.level = 0 GROUP BY ALL)"""


@query("band_lines", "site:b pair:s band:s win:b t_s:d coh:d", "W13", with_(REC, RGN, RAX, MAP, BAND) + "SELECT site, pair, band, base AS win, t_s, avg(v) AS coh FROM nw JOIN bl USING (site, pair, level, win) GROUP BY ALL")
def band_lines(t):
    return maps.band_lines(cmap(t), ["site"], {"short": (2.5, 8.0), "long": (6.0, 40.0)})


RUN = """lg AS (SELECT site, i, unnest(['hx', 'hy', 'hz', 'ex', 'ey']) AS chan, unnest([hx, hy, hz, ex, ey]) AS x FROM rax),
lr AS (SELECT site, chan, i, x, i - row_number() OVER (PARTITION BY site, chan ORDER BY i) AS g FROM lg WHERE x IS NOT NULL),
br AS (SELECT site, chan, min(i) AS run_start, max(i) AS run_end, count(*) AS run_len FROM lr GROUP BY site, chan, g QUALIFY row_number() OVER (PARTITION BY site, chan ORDER BY count(*) DESC, min(i)) = 1),
ru AS (SELECT site, chan, run_len, least(64, run_len) AS n, i - run_start AS q, x FROM lr JOIN br USING (site, chan) WHERE i BETWEEN run_start AND run_end AND run_len >= 16),
rs AS (SELECT site, chan, run_len, n, s, q - s * (n - n // 2) AS p, x FROM ru, (SELECT unnest(range(512)) AS s) WHERE s <= (run_len - n) // (n - n // 2) AND q - s * (n - n // 2) BETWEEN 0 AND n - 1),
rm AS (SELECT site, chan, s, avg(x) AS m FROM rs GROUP BY ALL),
rf AS (SELECT rs.site, rs.chan, run_len, n, rs.s, f, sum((0.5 - 0.5 * cos(2 * pi() * p / n)) * (x - m) * cos(2 * pi() * f * p / n)) AS re, sum((0.5 - 0.5 * cos(2 * pi() * p / n)) * (x - m) * sin(2 * pi() * f * p / n)) AS im
  FROM rs JOIN rm USING (site, chan, s), (SELECT unnest(range(1, 33)) AS f) WHERE f <= n // 2 GROUP BY ALL),
rp AS (SELECT site, chan, run_len, count(*) AS n_segments, f / CAST(n AS DOUBLE) AS f_hz, avg(re * re + im * im) / (n * 0.375) * CASE WHEN 2 * f = n THEN 1 ELSE 2 END AS power FROM rf GROUP BY site, chan, run_len, n, f)"""
CHANS = ["hx", "hy", "hz", "ex", "ey"]


@query("longest_runs", "site:b chan:s run_start:b run_end:b run_len:b", "X10 W4", with_(REC, RGN, RAX, RUN) + "SELECT * FROM br")
def longest_runs(t):
    return maps.longest_runs(rax(t), ["site"], "i", CHANS, block=512)


@query("run_spectra", "site:b chan:s run_len:b n_segments:b f_hz:d power:d", "X10", with_(REC, RGN, RAX, RUN) + "SELECT * FROM rp")
def run_spectra(t):
    return maps.run_spectra(rax(t), ["site"], "i", CHANS, nperseg=64, block=512)


@query("run_fall", "site:b chan:s from_hz:d to_hz:d decades_of_fall:d band_power:d", "X10", with_(REC, RGN, RAX, RUN) + """SELECT site, chan, 1 / 32.0 AS from_hz, 0.4 AS to_hz, log10(median(power) FILTER (WHERE f_hz BETWEEN 0.8 / 32.0 AND 1.2 / 32.0)) - log10(median(power) FILTER (WHERE f_hz BETWEEN 0.32 AND 0.4)) AS decades_of_fall,
  median(power) FILTER (WHERE f_hz BETWEEN 1 / 12.5 AND 1 / 7.5) AS band_power FROM rp GROUP BY ALL""")
def run_fall(t):
    s = maps.run_spectra(rax(t), ["site"], "i", CHANS, nperseg=64, block=512)
    return maps.decades_of_fall(s, ["site", "chan"], from_hz=1 / 32.0, power_band_s=(7.5, 12.5))


# segments of 16 days, three quarters of them shared, inside runs of 40 days that station and reference both hold; the reference is the next region
TFB = """jn AS (SELECT a.site, a.i, a.hx, a.hy, a.ex, a.ey, b.hx AS rx, b.hy AS ry FROM rax a JOIN rax b ON b.site = a.site + 1 AND b.i = a.i
  WHERE a.hx IS NOT NULL AND a.hy IS NOT NULL AND a.ex IS NOT NULL AND a.ey IS NOT NULL AND b.hx IS NOT NULL AND b.hy IS NOT NULL),
jr AS (SELECT *, min(i) OVER g AS a, count(*) OVER g AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY site ORDER BY i) AS g FROM jn) WINDOW g AS (PARTITION BY site, g)),
js AS (SELECT site, seg, i - seg AS p, unnest(['hx', 'hy', 'ex', 'ey', 'rx', 'ry']) AS chan, unnest([hx, hy, ex, ey, rx, ry]) AS x
  FROM (SELECT *, unnest(range(a, a + len - 15, 4)) AS seg FROM jr WHERE len >= 40) WHERE i BETWEEN seg AND seg + 15),
jm AS (SELECT site, seg, chan, avg(x) AS m FROM js GROUP BY ALL),
kw AS (SELECT p, sum(pow(100 * (1 - pow((p - 7.5) / 7.5, 2)), k) / pow(CAST(factorial(CAST(k AS INTEGER)) AS DOUBLE), 2)) / (SELECT sum(pow(100.0, k) / pow(CAST(factorial(CAST(k AS INTEGER)) AS DOUBLE), 2)) FROM (SELECT unnest(range(33)) AS k)) AS w
  FROM (SELECT unnest(range(16)) AS p), (SELECT unnest(range(33)) AS k) GROUP BY p),
jf AS (SELECT js.site, js.seg, js.chan, f, sum(w * (x - m) * cos(2 * pi() * f * js.p / 16)) AS re, -sum(w * (x - m) * sin(2 * pi() * f * js.p / 16)) AS im FROM js JOIN jm USING (site, seg, chan) JOIN kw ON kw.p = js.p, (SELECT unnest(range(1, 9)) AS f) GROUP BY ALL),
bd AS (SELECT * FROM (VALUES (1, 1, 3), (2, 3, 5), (3, 5, 8)) AS t(band, i0, i1)),
cp AS MATERIALIZED (SELECT a.site, band, a.chan AS c1, b.chan AS c2, sum(a.re * b.re + a.im * b.im) AS re, sum(a.im * b.re - a.re * b.im) AS im, count(*) AS n
  FROM jf a JOIN jf b ON a.site = b.site AND a.seg = b.seg AND a.f = b.f JOIN bd ON a.f BETWEEN i0 AND i1 GROUP BY ALL),
rr AS (SELECT site, band, max(n) AS n, {sums} FROM cp GROUP BY ALL),
dt AS (SELECT *, hxrx_re * hyry_re - hxrx_im * hyry_im - hxry_re * hyrx_re + hxry_im * hyrx_im AS dr, hxrx_re * hyry_im + hxrx_im * hyry_re - hxry_re * hyrx_im - hxry_im * hyrx_re AS di FROM rr),
nm AS ({nums}),
zz AS (SELECT *, (ar * dr + ai * di) / (dr * dr + di * di) AS z0r, (ai * dr - ar * di) / (dr * dr + di * di) AS z0i, (br * dr + bi * di) / (dr * dr + di * di) AS z1r, (bi * dr - br * di) / (dr * dr + di * di) AS z1i FROM nm),
rs AS (SELECT *, (see + (z0r * z0r + z0i * z0i) * hxhx_re + (z1r * z1r + z1i * z1i) * hyhy_re + 2 * ((z0r * z1r + z0i * z1i) * hxhy_re - (z0i * z1r - z0r * z1i) * hxhy_im)
  - 2 * (exr * z0r + exi * z0i) - 2 * (eyr * z1r + eyi * z1i)) / (n - 2) / (dr * dr + di * di) AS v FROM zz)"""
_PAIRS = [(a, b) for a in ("hx", "hy", "ex", "ey") for b in ("rx", "ry")] + [("rx", "rx"), ("ry", "ry"), ("rx", "ry"), ("hx", "hx"), ("hy", "hy"), ("hx", "hy")] + [(a, b) for a in ("ex", "ey") for b in (a, "hx", "hy")]
_SUMS = ", ".join(f"max({p}) FILTER (WHERE c1 = '{a}' AND c2 = '{b}') AS {a}{b}_{p}" for a, b in _PAIRS for p in ("re", "im"))
_NUMS = " UNION ALL ".join(f"""SELECT *, '{e}' AS e, {e}{e}_re AS see, {e}hx_re AS exr, {e}hx_im AS exi, {e}hy_re AS eyr, {e}hy_im AS eyi,
  {e}rx_re * hyry_re - {e}rx_im * hyry_im - {e}ry_re * hyrx_re + {e}ry_im * hyrx_im AS ar, {e}rx_re * hyry_im + {e}rx_im * hyry_re - {e}ry_re * hyrx_im - {e}ry_im * hyrx_re AS ai,
  {e}ry_re * hxrx_re - {e}ry_im * hxrx_im - {e}rx_re * hxry_re + {e}rx_im * hxry_im AS br, {e}ry_re * hxrx_im + {e}ry_im * hxrx_re - {e}rx_re * hxry_im - {e}rx_im * hxry_re AS bi FROM dt""" for e in ("ex", "ey"))


def _spread(h: str) -> str:
    """The part of a component's variance that the reference gives it; `h` is the other magnetic channel."""
    p, q = f"{h}ry", f"{h}rx"
    return f"""CASE WHEN n > 2 AND v IS NOT NULL THEN sqrt(greatest(greatest(v, 0) * (({p}_re * {p}_re + {p}_im * {p}_im) * rxrx_re + ({q}_re * {q}_re + {q}_im * {q}_im) * ryry_re
  - 2 * (({p}_re * {q}_re + {p}_im * {q}_im) * rxry_re + ({p}_im * {q}_re - {p}_re * {q}_im) * rxry_im)), 0)) END"""


@query("tf_bands", "site:b band:b comp:s re:d im:d err:d n:b", "X11 X12", with_(REC, RGN, RAX, TFB.format(sums=_SUMS, nums=_NUMS)) + f"""SELECT site, band, e || '_hx' AS comp, z0r AS re, z0i AS im, {_spread('hy')} AS err, n FROM rs
UNION ALL SELECT site, band, e || '_hy' AS comp, z1r AS re, z1i AS im, {_spread('hx')} AS err, n FROM rs""")
def tf_bands(t):
    chans = ["hx", "hy", "ex", "ey", "rx", "ry"]
    d = rax(t)
    both = d.join(d.select((F.col("site") - 1).alias("site"), "i", F.col("hx").alias("rx"), F.col("hy").alias("ry")), ["site", "i"])
    fc = spectral.segment_fft(spectral.run_segments(both, ["site"], "i", chans, 16, 4, 40, block=512), ["site"], chans, 1, 8, "kaiser")
    bands = t.spark.createDataFrame([(1, 1, 3), (2, 3, 5), (3, 5, 8)], "band int, i_min int, i_max int")
    return estimate.remote_reference(fc, ["site"], bands=bands, iterations=0, errors=True)
