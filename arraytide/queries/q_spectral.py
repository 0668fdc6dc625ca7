"""Segment spectra and what is summed from them, on the daily record of every region; a segment with a missing day is refused."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import estimate, spectral
from .bind import DAX, FLEET, RAX, REC, RGN, dax, fleet, rax, with_
from .registry import query

N = 16
FC = f"""sg AS (SELECT site, i // {N} AS seg, i % {N} AS p, unnest(['hx', 'hy', 'ex', 'ey']) AS chan, unnest([hx, hy, ex, ey]) AS x FROM rax),
sm AS (SELECT site, seg, chan, avg(x) AS m FROM sg GROUP BY ALL HAVING count(x) = {N}),
fc AS (SELECT sg.site, sg.seg, sg.chan, f, sum((0.5 - 0.5 * cos(2 * pi() * p / {N - 1}.0)) * (x - m) * cos(2 * pi() * f * p / {N}.0)) AS re, -sum((0.5 - 0.5 * cos(2 * pi() * p / {N - 1}.0)) * (x - m) * sin(2 * pi() * f * p / {N}.0)) AS im
  FROM sg JOIN sm ON sm.site = sg.site AND sm.seg = sg.seg AND sm.chan = sg.chan, (SELECT unnest(range(1, {N // 2 + 1})) AS f) GROUP BY ALL)"""


def fc(t, chans=("hx", "hy", "ex", "ey"), record=rax):
    a = spectral.as_arrays(record(t), ["site"], "i", list(chans), N)
    return spectral.segment_fft(a, ["site"], list(chans), 1, N // 2)


@query("segment_fft", "site:b seg:b chan:s f:b re:d im:d", "X3 D2", with_(REC, RGN, RAX, FC) + "SELECT * FROM fc")
def segment_fft(t):
    return fc(t)


@query("chunk_power", "site:b slot:b power:d", "X1", with_(REC, RGN, RAX, """ck AS (SELECT site, i // 32 AS slot, i % 32 AS q, hx FROM rax), wh AS (SELECT site, slot, avg(hx) AS m FROM ck GROUP BY ALL HAVING count(hx) = 32),
s AS (SELECT ck.site, ck.slot, s, q - 8 * s AS p, hx - m AS x FROM ck JOIN wh ON wh.site = ck.site AND wh.slot = ck.slot, (SELECT unnest([0, 1, 2]) AS s) WHERE q BETWEEN 8 * s AND 8 * s + 15),
sm AS (SELECT site, slot, s, avg(x) AS m FROM s GROUP BY ALL),
ft AS (SELECT s.site, s.slot, s.s, f, sum((0.5 - 0.5 * cos(2 * pi() * p / 16.0)) * (x - m) * cos(2 * pi() * f * p / 16.0)) AS re, sum((0.5 - 0.5 * cos(2 * pi() * p / 16.0)) * (x - m) * sin(2 * pi() * f * p / 16.0)) AS im
  FROM s JOIN sm ON sm.site = s.site AND sm.slot = s.slot AND sm.s = s.s, (SELECT unnest([2, 3, 4]) AS f) GROUP BY ALL),
pw AS (SELECT site, slot, f, 2 * avg(re * re + im * im) / 6.0 AS p FROM ft GROUP BY ALL)""") + "SELECT site, slot, median(p) AS power FROM pw GROUP BY ALL")
def chunk_power(t):
    return spectral.chunk_power(rax(t), ["site"], "i", "hx", 32, 16, (0.1, 0.26))


@query("signal_power", "label:b n:b power:d", "X1 M8", """WITH s AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS q, len(embedding) // 32 AS whole FROM embeddings), s1 AS (SELECT vec_id, label, q // 32 AS k, q % 32 AS p, x FROM s WHERE q // 32 < whole), m AS (SELECT vec_id, k, avg(x) AS m FROM s1 GROUP BY ALL),
ft AS (SELECT s1.vec_id, s1.k, label, f, sum((0.5 - 0.5 * cos(2 * pi() * p / 31.0)) * (x - m) * cos(2 * pi() * f * p / 32.0)) AS re, sum((0.5 - 0.5 * cos(2 * pi() * p / 31.0)) * (x - m) * sin(2 * pi() * f * p / 32.0)) AS im FROM s1 JOIN m ON m.vec_id = s1.vec_id AND m.k = s1.k, (SELECT unnest([1, 2, 3, 4]) AS f) GROUP BY ALL)
SELECT label, count(DISTINCT vec_id) AS n, sum(re * re + im * im) / count(DISTINCT (vec_id, k)) AS power FROM ft GROUP BY label""")
def signal_power(t):
    # every whole segment of 32 samples of each signal
    k = F.explode(F.sequence(F.lit(0), F.floor(F.size("embedding") / 32).cast("int") - 1))
    a = t.embeddings.where(F.size("embedding") >= 32).select("label", F.col("vec_id").alias("vec"), "embedding", k.alias("seg"))
    a = a.select("label", "vec", "seg", F.transform(F.slice("embedding", F.col("seg") * 32 + 1, 32), lambda x: x.cast("double")).alias("x"))
    z = spectral.segment_fft(a, ["label", "vec"], ["x"], 1, 4)
    z = z.groupBy("label").agg(F.countDistinct("vec").alias("n"), F.countDistinct("vec", "seg").alias("m"), F.sum(F.col("re") ** 2 + F.col("im") ** 2).alias("s"))
    return z.select("label", "n", (F.col("s") / F.col("m")).alias("power"))


PAIRC = """pj AS (SELECT a.site AS a, b.site AS b, a.chan, a.seg // 8 AS chunk, a.f, sum(a.re * a.re + a.im * a.im) AS pxx, sum(b.re * b.re + b.im * b.im) AS pyy, sum(a.re * b.re + a.im * b.im) AS xr, sum(a.im * b.re - a.re * b.im) AS xi, count(*) AS cnt
  FROM fc a JOIN fc b ON a.seg = b.seg AND a.chan = b.chan AND a.f = b.f AND b.site IN (a.site + 1, a.site + 2) WHERE a.chan IN ('hx', 'hy') GROUP BY ALL HAVING count(*) >= 4),
pv AS (SELECT a, b, chan, chunk, avg(least(greatest(g - (1 - g) * (1 - g) / cnt, 0), 1)) AS v FROM (SELECT *, (xr * xr + xi * xi) / nullif(pxx * pyy, 0) AS g FROM pj) GROUP BY ALL),
pc AS (SELECT a, b, chan, count(v) AS n, median(v) AS c FROM pv GROUP BY ALL)"""


def near_pairs(t):
    k = F.col("r_regionkey").cast("bigint")
    return t.region.select(k.alias("a"), F.explode(F.array(k + 1, k + 2)).alias("b"))


@query("segment_pairs", "a:b b:b chan:s coh:d chunks:b", "X3", with_(REC, RGN, RAX, FC, PAIRC) + "SELECT a, b, chan, CASE WHEN n >= 4 THEN c END AS coh, CASE WHEN n >= 4 THEN n ELSE 0 END AS chunks FROM pc")
def segment_pairs(t):
    return spectral.pair_coherence(fc(t, ("hx", "hy")), near_pairs(t), F.floor(F.col("seg") / 8), 4, 4)


# a pair is two stations with a record; one that shares too few whole segments has no coherence
MET = """met AS (SELECT a.site AS a, b.site AS b FROM (SELECT DISTINCT site FROM rax) a JOIN (SELECT DISTINCT site FROM rax) b ON b.site IN (a.site + 1, a.site + 2)),
both_ AS (SELECT a, b, CASE WHEN count(*) FILTER (WHERE n >= 4) = 2 THEN avg(c) END AS coh, min(CASE WHEN n >= 4 THEN n ELSE 0 END) AS chunks FROM pc GROUP BY ALL)"""


@query("pair_coherence", "a:b b:b coh:d chunks:b", "X3 J9", with_(REC, FLEET, FC, PAIRC, MET) + "SELECT a, b, coh, coalesce(chunks, 0) AS chunks FROM met LEFT JOIN both_ USING (a, b)")
def pair_coherence(t):
    sites = fleet(t).select(F.col("site").alias("a")).distinct()
    met = sites.withColumn("b", F.explode(F.array(F.col("a") + 1, F.col("a") + 2))).join(sites.withColumnRenamed("a", "b"), "b", "left_semi")
    coh = spectral.both_channels(spectral.pair_coherence(fc(t, ("hx", "hy"), fleet), met, F.floor(F.col("seg") / 8), 4, 4))
    return met.join(coh, ["a", "b"], "left").fillna(0, ["chunks"])


@query("mean_coherence", "site:b coh:d n_segments:b", "X9 J19", with_(REC, RGN, RAX, FC, """w AS (SELECT site, seg, f, max(re) FILTER (WHERE chan = 'hx') AS ar, max(im) FILTER (WHERE chan = 'hx') AS ai, max(re) FILTER (WHERE chan = 'hy') AS br, max(im) FILTER (WHERE chan = 'hy') AS bi FROM fc GROUP BY ALL),
s AS (SELECT site, f, sum(ar * br + ai * bi) AS xr, sum(ai * br - ar * bi) AS xi, sum(ar * ar + ai * ai) AS pa, sum(br * br + bi * bi) AS pb, count(*) AS n FROM w GROUP BY ALL)""") + "SELECT site, avg((xr * xr + xi * xi) / nullif(pa * pb, 0)) AS coh, min(n) AS n_segments FROM s GROUP BY site")
def mean_coherence(t):
    z = fc(t, ("hx", "hy"))
    s = spectral.cross_sums(z, ["site", "f"], ["hx", "hy"], ["hx", "hy"], ["site"])
    return spectral.mean_coherence(s, ["site"], "hx", "hy")


@query("decades_of_fall", "site:b chan:s decades_of_fall:d", "X10", with_(REC, RGN, RAX, FC, "p AS (SELECT site, chan, f, avg(re * re + im * im) AS p FROM fc GROUP BY ALL)") + "SELECT site, chan, log10(median(p) FILTER (WHERE f = 1)) - log10(median(p) FILTER (WHERE f >= 2)) AS decades_of_fall FROM p GROUP BY ALL")
def decades_of_fall(t):
    return spectral.fall(fc(t), ["site", "chan"], (1, 1), (2, N // 2))


BM = "bm AS (SELECT site, seg, chan, CASE WHEN f <= 2 THEN 0 ELSE 1 END AS bin, CASE WHEN avg(re * re + im * im) > 1e-12 THEN 10 * log10(avg(re * re + im * im)) END AS db FROM fc GROUP BY ALL), bn AS (SELECT * FROM bm WHERE db IS NOT NULL)"


@query("power_map", "site:b seg:b chan:s bin:b db:d", "W13", with_(REC, RGN, RAX, FC, BM) + "SELECT * FROM bm")
def power_map(t):
    return spectral.band_map(fc(t), ["site"], [(1, 2), (3, N // 2)])


@query("spectrogram_table", "site:b chan:s bin:b median_db:d below:d above:d windows:b", "A23 J22", with_(REC, RGN, RAX, FC, BM, "m AS (SELECT site, chan, bin, median(db) AS md FROM bn GROUP BY ALL)") + """SELECT bm.site, bm.chan, bm.bin, max(md) AS median_db, avg(CASE WHEN db < md - 10 THEN 1.0 ELSE 0 END) AS below, avg(CASE WHEN db > md + 10 THEN 1.0 ELSE 0 END) AS above, count(*) AS windows
  FROM bn bm JOIN m ON m.site = bm.site AND m.chan = bm.chan AND m.bin = bm.bin GROUP BY ALL""")
def spectrogram_table(t):
    return spectral.away_from_median(spectral.band_map(fc(t), ["site"], [(1, 2), (3, N // 2)]), ["site", "chan", "bin"])


@query("block_coherence", "site:b seg:b coh_ex_hy:d coh_ey_hx:d coh_ex_ey:d std_ex:d std_ey:d", "X2 X8")
def block_coherence(t):
    # days out of service are bridged before the filter, up to a fifth of a stretch
    a = spectral.as_arrays(rax(t), ["site"], "i", ["hx", "hy", "ex", "ey"], 128, whole=False).where("n = 128")
    return spectral.welch_coherence(a, ["site", "seg"], {"coh_ex_hy": ("ex", "hy"), "coh_ey_hx": ("ey", "hx"), "coh_ex_ey": ("ex", "ey")}, 3.0, 12.0, 32,
                                    prep=(2, [1 / 60.0], "high"), stds=["ex", "ey"])


OCT = """df AS (SELECT site, i // 256 AS stretch, i % 256 - 1 AS p, unnest(['hx', 'hy']) AS chan, unnest([hx - lag(hx) OVER w, hy - lag(hy) OVER w]) AS x FROM rax WINDOW w AS (PARTITION BY site, i // 256 ORDER BY i)),
sg AS (SELECT site, stretch, s, p - 16 * s AS q, chan, x FROM df, (SELECT unnest(range(15)) AS s) WHERE p BETWEEN 16 * s AND 16 * s + 31),
ln AS (SELECT site, stretch, s, chan, avg(x) AS m, regr_slope(x, q) AS b FROM sg GROUP BY ALL HAVING count(x) = 32),
ft AS (SELECT sg.site, sg.stretch, sg.s, f, sg.chan, sum((0.5 - 0.5 * cos(2 * pi() * q / 32.0)) * (x - m - b * (q - 15.5)) * cos(2 * pi() * f * q / 32.0)) AS re, -sum((0.5 - 0.5 * cos(2 * pi() * q / 32.0)) * (x - m - b * (q - 15.5)) * sin(2 * pi() * f * q / 32.0)) AS im
  FROM sg JOIN ln USING (site, stretch, s, chan), (SELECT unnest(range(1, 17)) AS f) GROUP BY ALL),
pr AS (SELECT a.site, a.stretch, a.f, sum(a.re * b.re + a.im * b.im) AS xr, sum(a.im * b.re - a.re * b.im) AS xi, sum(a.re * a.re + a.im * a.im) AS pa, sum(b.re * b.re + b.im * b.im) AS pb
  FROM ft a JOIN ft b ON a.site = b.site AND a.stretch = b.stretch AND a.s = b.s AND a.f = b.f AND a.chan = 'hx' AND b.chan = 'hy' GROUP BY ALL),
bd AS (SELECT site, stretch, k, median((xr * xr + xi * xi) / nullif(pa * pb, 0)) AS g FROM pr, (SELECT unnest(range(4)) AS k) WHERE f / 32.0 > 1 / (2.5 * pow(8.0, (k + 1) / 4.0)) AND f / 32.0 < 1 / (2.5 * pow(8.0, k / 4.0)) GROUP BY ALL)"""


# one row per stretch of a record; a stretch without a whole segment has no coherence
OCTAVES = """oc AS (SELECT site, stretch, least(greatest((median(g) - 1 / 12.3) / (1 - 1 / 12.3), 0), 1) AS coh FROM bd GROUP BY ALL)"""


@query("octave_coherence", "site:b stretch:b coh:d", "X4", with_(REC, FLEET, OCT, OCTAVES) + "SELECT site, stretch, coh FROM (SELECT DISTINCT site, i // 256 AS stretch FROM rax) LEFT JOIN oc USING (site, stretch)")
def octave_coherence(t):
    record = fleet(t)
    a = spectral.difference_segments(record, ["site"], "i", ["hx", "hy"], 256, 32)
    z = spectral.segment_fft(a, ["site", "stretch"], ["hx", "hy"], 1, 16, "periodic", linear=True)
    coh = spectral.octave_coherence(z, ["site", "stretch"], "hx", "hy", 2.5, 20.0, 32, 256)
    return record.select("site", F.floor(F.col("i") / 256).alias("stretch")).distinct().join(coh, ["site", "stretch"], "left")


@query("sliding_coherence", "site:b seg:b coh:d", "W13 R3")
def sliding_coherence(t):
    a = spectral.as_arrays(rax(t), ["site"], "i", ["hx", "hy"], 60, 30)
    return spectral.welch_coherence(a, ["site", "seg"], {"coh": ("hx", "hy")}, 3.0, 12.0, 15)


@query("residual_centre", "site:b chunk:b coh_r:d gain:d mcoh_diff:d mcoh_sum:d coh_ex_ey:d n_harmonics:b", "X5 J20")
def residual_centre(t):
    c = ["ex", "ey", "hx", "hy"]
    s = spectral.cross_sums(fc(t), ["site", F.floor(F.col("seg") / 16).alias("chunk"), "f"], c, c, ["site"]).where(F.col("n") >= 8)
    return spectral.residual_stats(s, ["site", "chunk"], F.lit(50.0), F.lit(60.0))


@query("centre_verdict", "site:b n_days:b gain_ratio:d model_holds:z clean_obs:s clean_by_h:s remedy:z control:z", "J20 A29")
def centre_verdict(t):
    from ..operators import site
    d = residual_centre(t).withColumns({"gain_expected": F.lit(50.0 / 60.0), "src": F.col("coh_ex_ey")})
    return site.centre_verdict(d, ["site"])


@query("tf_estimate", "site:b band:b comp:s re:d im:d n:b", "X11")
def tf_estimate(t):
    local = fc(t)
    ref = fc(t, ("hx", "hy")).withColumn("site", F.col("site") - 1)
    both = estimate.with_remote(local, ref, ["site"])
    return estimate.remote_reference(both, ["site"], iterations=2)


@query("split_half", "site:b half:s band:b comp:s re:d im:d n:b", "X11 P9")
def split_half(t):
    z = fc(t)
    mid = z.groupBy("site").agg(F.min("seg").alias("a"), (F.max("seg") - F.min("seg") + 1).alias("n"))
    z = z.join(mid, "site").withColumn("half", F.when(F.col("seg") - F.col("a") < F.floor(F.col("n") / 2), "half1").otherwise("half2")).drop("a", "n")
    return estimate.remote_reference(z, ["site", "half"], r=("hx", "hy"), iterations=1)


DEC = """fl AS (SELECT site, i, last_value(CASE WHEN hx IS NOT NULL THEN i END IGNORE NULLS) OVER p AS pi, last_value(hx IGNORE NULLS) OVER p AS pv, first_value(CASE WHEN hx IS NOT NULL THEN i END IGNORE NULLS) OVER n AS ni, first_value(hx IGNORE NULLS) OVER n AS nv
  FROM dax WINDOW p AS (PARTITION BY site ORDER BY i ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY site ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
x AS (SELECT site, i, CASE WHEN pi IS NULL THEN nv WHEN ni IS NULL OR ni = pi THEN pv ELSE pv + (nv - pv) * (i - pi) / CAST(ni - pi AS DOUBLE) END AS x FROM fl),
rw AS (SELECT j, CASE WHEN j = 40 THEN 1.0 ELSE sin(pi() * (j - 40) / 4.0) / (pi() * (j - 40) / 4.0) END * (0.54 - 0.46 * cos(2 * pi() * j / 80.0)) AS w FROM (SELECT unnest(range(81)) AS j)),
h AS (SELECT j, w / sum(w) OVER () AS h FROM rw),
sl AS (SELECT site, unnest(range((min(i) + 3) // 4, (max(i) + 1) // 4)) AS slot FROM dax GROUP BY site),
y AS (SELECT site, slot, sum(h * x) AS y FROM (SELECT site, i, x, unnest(range((i - 37) // 4, (i + 40) // 4 + 1)) AS slot FROM x) JOIN h ON j = i - slot * 4 + 40 GROUP BY ALL),
c AS (SELECT site, i // 4 AS slot, count(hx) AS n FROM dax GROUP BY ALL)"""


@query("decimated", "site:b slot:b value:d", "W9 K1", with_(REC, DAX, DEC) + "SELECT site, slot, CASE WHEN n = 4 THEN y END AS value FROM sl LEFT JOIN y USING (site, slot) LEFT JOIN c USING (site, slot)")
def decimated(t):
    return spectral.decimate(dax(t), ["site"], "i", "hx", 4, block=256)


@query("map_levels", "fs_hz:d level:b segment:b window_s:b level_step_s:b from_s:d to_s:d", "W12", """WITH r AS (SELECT DISTINCT CAST(p_size AS DOUBLE) AS fs_hz FROM part), b AS (SELECT fs_hz, pow(2.0, floor(log2(900.0 * fs_hz) + 1e-9)) AS n0 FROM r),
k AS (SELECT fs_hz, n0, unnest(range(0, 1 + greatest(0, CAST(ceil(ln(20000.0 * fs_hz / n0) / ln(4.0) - 1e-9) AS BIGINT)))) AS level FROM b), s AS (SELECT *, n0 * pow(4.0, level) AS n FROM k)
SELECT fs_hz, level, n AS segment, CASE WHEN level = 0 THEN 3600 ELSE floor(6 * n / fs_hz) END AS window_s, CASE WHEN level = 0 THEN 1800 ELSE greatest(1800, floor(n / fs_hz / 2)) END AS level_step_s, CASE WHEN level = 0 THEN 2.0 ELSE n / fs_hz / 4 END AS from_s, least(n / fs_hz, 20000.0) AS to_s FROM s""")
def map_levels(t):
    return estimate.map_levels(t.part.select(F.col("p_size").cast("double").alias("fs_hz")).distinct())


@query("band_edges", "level:b i_min:b i_max:b fs_hz:d lower_s:d centre_s:d upper_s:d n:b", "X12", """WITH p AS (SELECT p_size % 6 + 1 AS level, p_size AS i_min, p_size + p_partkey % 7 AS i_max, count(*) AS n FROM part GROUP BY ALL)
SELECT level, i_min, i_max, n, r AS fs_hz, 1 / ((i_max + 0.5) * r / 256) AS lower_s, 2 / ((i_min + i_max) * r / 256) AS centre_s, 1 / ((i_min - 0.5) * r / 256) AS upper_s FROM (SELECT *, 1.0 / pow(4.0, level - 1) AS r FROM p)""")
def band_edges(t):
    s = F.col("p_size")
    p = t.part.groupBy((s % 6 + 1).alias("level"), s.alias("i_min"), (s + F.col("p_partkey") % 7).alias("i_max")).agg(F.count(F.lit(1)).alias("n"))
    return estimate.band_edges(p, 256, 1.0)
