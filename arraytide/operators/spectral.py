"""Spectra of segments, chunks and days, and everything that is a sum over them.

The Fourier transform of a bounded array is the only thing Python does. Segments are transformed once into a long
table (keys, seg, f, re, im); cross powers, coherences, gains and responses are joins and sums of that table.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import kernels, scalars
from .blocks import BLK, block_of, neighbours
from .islands import RUN_BLOCK, runs

# fixed values
PAIR_NPERSEG, PAIR_MIN_SEGMENTS = 1024, 24
WEIGHT_NPERSEG, WEIGHT_MIN_SEGMENTS = 4096, 6
MIN_CHUNKS = 4
CHUNK_S, CHUNK_NPERSEG, CHUNK_BAND = 600, 512, (0.005, 0.05)
LAG_MIN_CORR, LAG_MAX_SPREAD, LAG_MIN_LONG = 0.35, 1.0, 0.5
CLOCK_MIN_CORR, CLOCK_RATIO, CLOCK_EDGE, CLOCK_PASS, CLOCK_MIN_DAYS = 0.5, 1.5, 0.95, 10.0, 5
NU = 0.82


def as_arrays(samples: DataFrame, keys: list[str], pos: str, values: list[str], size: int, step: int | None = None,
              whole: bool = True) -> DataFrame:
    """(keys, seg, n, <value> arrays): runs of `size` positions every `step`, whole and finite unless told otherwise.

    A segment is a fixed number of samples, so the list it is gathered into is bounded.
    """
    step = step or size
    lo = block_of(F.col(pos) - size + step, step)
    d = samples.withColumn("seg", F.explode(F.sequence(lo, block_of(pos, step))))
    ok = F.lit(True)
    for v in values:
        ok = ok & F.col(v).isNotNull()
    if whole:
        d = d.where(ok)
    g = d.groupBy(*keys, "seg").agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), *values))).alias("_a"), F.count(F.lit(1)).alias("n"))
    if whole:
        g = g.where(F.col("n") == size)
    return g.select(*keys, "seg", "n", *[F.col(f"_a.{v}").cast("array<double>").alias(v) for v in values])


def run_segments(samples: DataFrame, keys: list[str], pos: str, values: list[str], size: int, step: int, min_len: int = 0, block: int = RUN_BLOCK) -> DataFrame:
    """(keys, seg, <value> arrays): segments every `step` samples from the first one of each run of at least `min_len` positions on which every value
    is there; `seg` is the segment's first position. Shorter runs, and what is left behind a run's last segment, are not used."""
    c, ok = F.col, F.lit(True)
    for v in values:
        ok = ok & c(v).isNotNull()
    d = samples.where(ok).select(*keys, c(pos).cast("bigint").alias(pos), *values)
    r = runs(d, keys, pos, min_len=max(min_len, size), block=block)
    # runs meet their samples block by block
    r = r.withColumn(BLK, F.explode(F.sequence(block_of("run_start", block), block_of("run_end", block))))
    d = d.withColumn(BLK, block_of(pos, block)).join(r, [*keys, BLK]).where(c(pos).between(c("run_start"), c("run_end")))
    x = c(pos) - c("run_start")
    lo, hi = F.greatest(block_of(x - size + step, step), F.lit(0)), F.least(block_of(x, step), block_of(c("run_len") - size, step))
    d = d.where(lo <= hi).withColumn("seg", F.explode(F.sequence(lo, hi))).withColumn("seg", c("run_start") + c("seg") * step)
    g = d.groupBy(*keys, "seg").agg(F.array_sort(F.collect_list(F.struct(c(pos).alias("p"), *values))).alias("_a"))
    return g.select(*keys, "seg", *[c(f"_a.{v}").cast("array<double>").alias(v) for v in values])


def _np(a) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in a], float)


def segment_fft(arrays: DataFrame, keys: list[str], values: list[str], f_lo: int, f_hi: int, window: str = "symmetric", linear: bool = False) -> DataFrame:
    """(keys, seg, chan, f, re, im): one windowed transform per segment and channel, less its mean or its line, bins f_lo..f_hi."""
    def transform(col: pd.Series) -> pd.DataFrame:
        if not len(col):
            return pd.DataFrame({"re": [], "im": []}, dtype=object)
        x = np.stack([np.asarray(v, float) for v in col])
        n = x.shape[1]
        w = np.hanning(n) if window == "symmetric" else np.kaiser(n, 20.0) if window == "kaiser" else kernels.hann(n)
        x = x - x.mean(axis=1, keepdims=True)
        z = np.fft.rfft((kernels.without_line(x) if linear else x) * w, axis=1)[:, f_lo:f_hi + 1]
        return pd.DataFrame({"re": list(z.real), "im": list(z.imag)})
    fft = F.pandas_udf(transform, "re array<double>, im array<double>")
    d = arrays.select(*keys, "seg", F.explode(F.array(*[F.struct(F.lit(v).alias("chan"), F.col(v).alias("x")) for v in values])).alias("c"))
    z = d.select(*keys, "seg", "c.chan", fft("c.x").alias("z"))
    return z.select(*keys, "seg", "chan", F.posexplode(F.arrays_zip("z.re", "z.im")).alias("k", "v")).select(
        *keys, "seg", "chan", (F.col("k") + f_lo).alias("f"), F.col("v.re").alias("re"), F.col("v.im").alias("im"))


def pair_coherence(fc: DataFrame, pairs: DataFrame, chunk_of: Column, min_segments: int, min_chunks: int, site: str = "site") -> DataFrame:
    """(a, b, chan, coh, chunks): band-mean squared coherence per chunk of segments, bias removed, median over chunks.

    Only named pairs meet, on the segment and harmonic both hold. Segments are summed, never concatenated.
    """
    p = pairs.select("a", "b")
    x = p.join(fc.select(F.col(site).alias("a"), "seg", "chan", "f", F.col("re").alias("ar"), F.col("im").alias("ai")), "a")
    j = x.join(fc.select(F.col(site).alias("b"), "seg", "chan", "f", F.col("re").alias("br"), F.col("im").alias("bi")), ["b", "seg", "chan", "f"])
    c = F.col
    s = j.groupBy("a", "b", "chan", chunk_of.alias("chunk"), "f").agg(
        F.sum(c("ar") ** 2 + c("ai") ** 2).alias("pxx"), F.sum(c("br") ** 2 + c("bi") ** 2).alias("pyy"), F.sum(c("ar") * c("br") + c("ai") * c("bi")).alias("xr"),
        F.sum(c("ai") * c("br") - c("ar") * c("bi")).alias("xi"), F.count(F.lit(1)).alias("cnt")).where(c("cnt") >= min_segments)
    g2 = F.try_divide(c("xr") ** 2 + c("xi") ** 2, c("pxx") * c("pyy"))
    s = s.withColumn("g", g2).withColumn("g", F.least(F.greatest(c("g") - (1 - c("g")) ** 2 / c("cnt"), F.lit(0.0)), F.lit(1.0)))
    per = s.groupBy("a", "b", "chan", "chunk").agg(F.avg("g").alias("v"))
    g = per.groupBy("a", "b", "chan").agg(F.median("v").alias("coh"), F.count("v").alias("chunks"))
    return g.select("a", "b", "chan", F.when(F.col("chunks") >= min_chunks, F.col("coh")).alias("coh"),
                    F.when(F.col("chunks") >= min_chunks, F.col("chunks")).otherwise(F.lit(0)).alias("chunks"))


def both_channels(coh: DataFrame) -> DataFrame:
    """Mean over the two horizontal channels where both were measured, and the fewer chunks."""
    return coh.groupBy("a", "b").agg(F.when(F.count("coh") == 2, F.avg("coh")).alias("coh"), F.min("chunks").alias("chunks"))


def chunk_power(samples: DataFrame, keys: list[str], pos: str, value: str, chunk: int = CHUNK_S, nperseg: int = CHUNK_NPERSEG,
                band=CHUNK_BAND, fs: float = 1.0) -> DataFrame:
    """Median Welch power over a band of every whole chunk, the last one included."""
    @F.pandas_udf("double")
    def power(col: pd.Series) -> pd.Series:
        if not len(col):
            return pd.Series([], dtype=float)
        x = np.stack([np.asarray(v, float) for v in col])
        f, p = kernels.psd(x - x.mean(axis=1, keepdims=True), fs, nperseg)
        m = (f >= band[0]) & (f <= band[1])
        return pd.Series(np.median(p[:, m], axis=1) if m.any() else np.full(len(x), np.nan))
    a = as_arrays(samples, keys, pos, [value], chunk)
    return a.select(*keys, F.col("seg").alias("slot"), F.nanvl(power(value), F.lit(None).cast("double")).alias("power"))


def _stacks(pdf: pd.DataFrame, chans: list[str]):
    """(row numbers, {channel: stack}) of the rows whose arrays are of one length."""
    sizes = pdf[chans].map(len)
    for n in pd.unique(sizes[chans[0]]):
        rows = np.flatnonzero((sizes == n).all(axis=1))
        if len(rows):
            yield rows, {c: np.stack([_np(v) for v in pdf[c].iloc[rows]]) for c in chans}


def _with_columns(pdf: pd.DataFrame, keep: list[str], made: dict[str, np.ndarray]) -> pd.DataFrame:
    out = pdf[keep].copy()
    for k, v in made.items():
        out[k] = v
    return out


def _schema(df: DataFrame, keep: list[str], made: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + "".join(f", `{n}` double" for n in made)


def welch_coherence(arrays: DataFrame, keep: list[str], pairs: dict[str, tuple[str, str]], lo_s: float, hi_s: float, nperseg: int,
                    fs: float = 1.0, prep: tuple | None = None, stds: list[str] = ()) -> DataFrame:
    """Band coherence of channel pairs in every array row, NULL where a channel is refused. All rows of a batch go through together.

    `prep` = (order, edge Hz, kind) filters each channel first, after a despike and a bridge over its gaps; `stds` adds the deviation of
    filtered channels.
    """
    chans = sorted({c for p in pairs.values() for c in p} | set(stds))
    names = list(pairs) + [f"std_{c}" for c in stds]

    def run(batches):
        coef = kernels.butter(prep[0], prep[1], fs, prep[2]) if prep else None
        for pdf in batches:
            made = {k: np.full(len(pdf), np.nan) for k in names}
            for rows, x in _stacks(pdf, chans):
                if coef is not None:
                    x = {c: kernels.filtered(v, *coef) for c, v in x.items()}
                fine = np.all([np.isfinite(v).all(axis=1) for v in x.values()], axis=0)
                x = {c: v[fine] for c, v in x.items()}
                for k, (a, b) in pairs.items():
                    made[k][rows[fine]] = kernels.band_median(*kernels.coherence(x[a], x[b], fs, nperseg), lo_s, hi_s)
                for c in stds:
                    made[f"std_{c}"][rows[fine]] = x[c].std(axis=1)
            yield _with_columns(pdf, keep, made)
    got = arrays.select(*keep, *chans).mapInPandas(run, _schema(arrays, keep, names))
    return got.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def octave_coherence(fc: DataFrame, keys: list[str], a: str, b: str, lo_s: float, hi_s: float, nperseg: int, samples: int, fs: float = 1.0,
                     octaves: int = 4) -> DataFrame:
    """(keys, coh): the median over octave sub-bands of the median coherence in each, less the bias of so few segments.

    `fc` holds half-overlapping segments of first differences of stretches of `samples` samples (`keys` name a stretch). Coherence is one
    sum over the segments of a harmonic; sub-bands are a join with their edges.
    """
    nu = NU * max(1, (samples - nperseg) // (nperseg // 2) + 1)
    c, edge = F.col, lambda k: lo_s * (hi_s / lo_s) ** (k / octaves)
    s = cross_sums(fc, [*keys, "f"], [a, b], [a, b], keys)
    s = s.select(*keys, (F.col("f") * F.lit(fs / nperseg)).alias("hz"),
                 F.try_divide(c(f"{a}_{b}_re") ** 2 + c(f"{a}_{b}_im") ** 2, c(f"{a}_{a}_re") * c(f"{b}_{b}_re")).alias("g"))
    bands = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(1 / edge(k + 1)).alias("lo"), F.lit(1 / edge(k)).alias("hi")) for k in range(octaves)])
    s = s.withColumn("band", F.explode(bands)).where((c("hz") > c("band.lo")) & (c("hz") < c("band.hi")))
    g = s.groupBy(*keys, c("band.k").alias("k")).agg(F.median("g").alias("g")).groupBy(*keys).agg(F.median("g").alias("g"))
    enough = samples >= 4 * nperseg and nu > 2
    return g.select(*keys, F.least(F.greatest((c("g") - 1 / nu) / (1 - 1 / nu), F.lit(0.0)), F.lit(1.0)).alias("coh") if enough
                    else F.lit(None).cast("double").alias("coh"))


def difference_segments(samples: DataFrame, keys: list[str], pos: str, values: list[str], stretch: int, nperseg: int) -> DataFrame:
    """Half-overlapping segments of first differences of every whole stretch of `stretch` samples, for `segment_fft`; keys gain `stretch`."""
    d = samples.withColumn("stretch", block_of(pos, stretch))
    w = Window.partitionBy(*keys, "stretch").orderBy(pos)
    step = {v: F.when(F.col(pos) - F.lag(pos).over(w) == 1, F.col(v) - F.lag(v).over(w)).alias(v) for v in values}
    d = d.select(*keys, "stretch", (F.pmod(F.col(pos), F.lit(stretch)) - 1).alias("_p"), *step.values()).where("_p >= 0")
    return as_arrays(d, [*keys, "stretch"], "_p", values, nperseg, nperseg // 2)


def decimate(samples: DataFrame, keys: list[str], pos: str, value: str, q: int, block: int = 8640) -> DataFrame:
    """(keys, slot, value): zero-phase decimation by q, NULL where any of the q inputs of a slot is missing.

    Slots run from the first to the last whole one of a record, those inside gaps included. Gaps are bridged by a straight line between the
    samples beside them, however far apart, record ends by their nearest sample, and the filter sees zero outside the record. Every sample
    adds its weighted value to the slots in reach, so the result is a sum and does not know of blocks.
    """
    reach = 10 * q
    taps = F.array(*[F.lit(float(h)) for h in kernels.fir_decimator(q)])
    t = samples.select(*keys, F.col(pos).cast("bigint").alias("_p"), F.col(value).cast("double").alias("_v"))
    span = t.groupBy(*keys).agg(F.min("_p").alias("_first"), F.max("_p").alias("_last"))
    good = t.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    c = F.col
    near = neighbours(good, keys, "_p", "_v", block, strict=True)
    # straight pieces: from a sample to the next one, and level ones at the ends of a record
    line = near.where(c("next_pos").isNotNull()).select(*keys, c("_p").alias("a"), (c("next_pos") - 1).alias("b"), "_v", ((c("next_val") - c("_v")) / (c("next_pos") - c("_p"))).alias("m"))
    ends = near.where(c("prev_pos").isNull() | c("next_pos").isNull()).join(span, keys)
    level = F.lit(0.0).alias("m")
    head = ends.where(c("prev_pos").isNull() & (c("_first") < c("_p"))).select(*keys, c("_first").alias("a"), (c("_p") - 1).alias("b"), "_v", level)
    tail = ends.where(c("next_pos").isNull()).select(*keys, c("_p").alias("a"), c("_last").alias("b"), "_v", level)
    pieces = line.unionByName(head).unionByName(tail)
    # only what is in reach of a sample can count: the middle of a long gap is left out
    far = reach + q
    where = F.when(c("b") - c("a") > 2 * far, F.array_union(F.sequence(c("a"), c("a") + far), F.sequence(c("b") - far, c("b")))).otherwise(F.sequence("a", "b"))
    dense = pieces.select(*keys, "a", "_v", "m", F.explode(where).alias("p")).select(*keys, "p", (c("_v") + c("m") * (c("p") - c("a"))).alias("x"))
    hit = dense.select(*keys, "p", "x", F.explode(F.sequence(block_of(c("p") - reach + q - 1, q), block_of(c("p") + reach, q))).alias("slot"))
    sums = hit.groupBy(*keys, "slot").agg(F.sum(c("x") * F.get(taps, (c("slot") * q - c("p") + reach).cast("int"))).alias("_y"))
    whole = good.groupBy(*keys, block_of("_p", q).alias("slot")).agg(F.countDistinct("_p").alias("_n")).where(c("_n") == q)
    edges = span.select(*keys, block_of(c("_first") + q - 1, q).alias("lo"), (block_of(c("_last") + 1, q) - 1).alias("hi")).where("lo <= hi")
    runs = edges.select(*keys, "lo", "hi", F.explode(F.sequence(block_of("lo", block), block_of("hi", block))).alias("_run"))
    slots = runs.select(*keys, F.explode(F.sequence(F.greatest("lo", c("_run") * block), F.least("hi", (c("_run") + 1) * block - 1))).alias("slot"))
    return slots.join(whole.join(sums, [*keys, "slot"]), [*keys, "slot"], "left").select(*keys, "slot", c("_y").alias("value"))


def window_lags(windows: DataFrame, keep: list[str], a: str, b: str, max_lag: int, band=None, fs: float = 1.0, edge: float = CLOCK_EDGE) -> DataFrame:
    """(keep, lag_s, r, ratio, edge) of the correlation peak of two channels of every window row; NULL where a sample is missing."""
    made = ["lag_s", "r", "ratio"]

    def run(batches):
        coef = kernels.butter(4, band, fs, "band") if band else None
        for pdf in batches:
            out = {k: np.full(len(pdf), np.nan) for k in made}
            for rows, x in _stacks(pdf, [a, b]):
                if coef is not None:
                    x = {k: kernels.filtfilt(*coef, v) for k, v in x.items()}
                fine = np.isfinite(x[a]).all(axis=1) & np.isfinite(x[b]).all(axis=1)
                if fine.any():
                    peak = kernels.correlation_peaks(x[a][fine], x[b][fine], max_lag)
                    for k, v in zip(made, (peak["lag"] / fs, peak["r"], peak["ratio"]), strict=True):
                        out[k][rows[fine]] = v
            yield _with_columns(pdf, keep, out)
    got = windows.select(*keep, a, b).mapInPandas(run, _schema(windows, keep, made))
    got = got.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in made})
    # the peak sample itself decides, not its place between samples
    return got.withColumn("edge", F.abs(F.round(F.col("lag_s") * fs)) >= edge * max_lag)


def lag_verdict(lags: DataFrame, keys: list[str], window: str, long_corr: DataFrame | None = None, min_corr: float = LAG_MIN_CORR,
                max_spread: float = LAG_MAX_SPREAD, min_long: float = LAG_MIN_LONG) -> DataFrame:
    """One lag per member: the median of the window medians, or 0 with the gate that refused it."""
    ok = lags.where(F.col("r") >= min_corr)
    per = ok.groupBy(*keys, window).agg(F.median("lag_s").alias("m"))
    g = per.groupBy(*keys).agg(F.median("m").alias("_lag"), (F.max("m") - F.min("m")).alias("spread"), F.count(F.lit(1)).alias("n_windows"))
    d = lags.select(*keys).distinct().join(g, keys, "left")
    if long_corr is not None:
        d = d.join(long_corr, keys, "left")
    else:
        d = d.withColumn("long_r", F.lit(1.0))
    why = (F.when(F.col("_lag").isNull(), "no usable window").when(F.coalesce(F.col("long_r") < min_long, F.lit(True)), "the long band does not correlate")
           .when(F.col("spread") > max_spread, "the lag is not one constant").otherwise(""))
    d = d.withColumn("note", why)
    return d.select(*keys, F.when(F.col("note") == "", F.col("_lag")).otherwise(F.lit(0.0)).alias("lag_s"), "spread", F.coalesce("n_windows", F.lit(0)).alias("n_windows"), "note")


def clock_verdict(days: DataFrame, keys: list[str], min_days: int = CLOCK_MIN_DAYS, limit: float = CLOCK_PASS) -> DataFrame:
    """Median lag over the days that count: field near the model, peak high, sharp and away from the search edge."""
    counted = (F.abs(F.col("f_ratio") - 1) < 0.20) & (F.col("r") >= CLOCK_MIN_CORR) & (F.col("ratio") >= CLOCK_RATIO) & ~F.col("edge")
    g = days.groupBy(*keys).agg(F.count_if(counted).alias("n_days"), F.median(F.when(counted, F.col("lag_s"))).alias("_m"), F.count(F.lit(1)).alias("n_offered"))
    judged = F.col("n_days") >= min_days
    return g.select(*keys, "n_offered", "n_days", judged.alias("judged"), F.when(judged, F.col("_m")).alias("median_lag_s"), F.coalesce(judged & (F.abs("_m") <= limit), F.lit(False)).alias("ok"))


# ---------------------------------------------------------------- sums of the long table

def cross_sums(fc: DataFrame, by: list[Column | str], left: list[str], right: list[str], keys: list[str], weight: Column | None = None) -> DataFrame:
    """Sums over segments of conj-products l r* for named channels: one column pair <l>_<r>_re, <l>_<r>_im."""
    chans = sorted(set(left) | set(right))
    w = F.lit(1.0) if weight is None else weight
    wide = fc.groupBy(*keys, "seg", "f").agg(*[F.max(F.when(F.col("chan") == c, F.col(p))).alias(f"{c}_{p}") for c in chans for p in ("re", "im")])
    aggs = []
    for l in left:
        for r in right:
            re, im = scalars.cmul((F.col(f"{l}_re"), F.col(f"{l}_im")), scalars.conj((F.col(f"{r}_re"), F.col(f"{r}_im"))))
            aggs += [F.sum(w * re).alias(f"{l}_{r}_re"), F.sum(w * im).alias(f"{l}_{r}_im")]
    return wide.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n"))


def _c(name: str) -> tuple[Column, Column]:
    return F.col(name + "_re"), F.col(name + "_im")


def residual_stats(sums: DataFrame, keys: list[str], ln: Column, le: Column) -> DataFrame:
    """Coherence and gain of what two lines share after the field is taken out, and how each diagonal follows the field.

    `sums` holds the cross sums of ex, ey, hx, hy per harmonic. The 2 x 2 inverse is in closed form.
    """
    hh = {(i, j): _c(f"{i}_{j}") for i in ("hx", "hy") for j in ("hx", "hy")}
    det = scalars.csub(scalars.cmul(hh["hx", "hx"], hh["hy", "hy"]), scalars.cmul(hh["hx", "hy"], hh["hy", "hx"]))
    neg = lambda z: (-z[0], -z[1])
    inv = {("hx", "hx"): hh["hy", "hy"], ("hy", "hy"): hh["hx", "hx"], ("hx", "hy"): neg(hh["hx", "hy"]), ("hy", "hx"): neg(hh["hy", "hx"])}
    dd = det[0] * det[0] + det[1] * det[1]

    def quad(e1: str, e2: str) -> tuple[Column, Column]:
        re, im = F.lit(0.0), F.lit(0.0)
        for i in ("hx", "hy"):
            for j in ("hx", "hy"):
                t = scalars.cmul(scalars.cmul(_c(f"{e1}_{i}"), inv[i, j]), _c(f"{j}_{e2}"))
                t = scalars.cmul(t, scalars.conj(det))
                re, im = re + F.try_divide(t[0], dd), im + F.try_divide(t[1], dd)
        return re, im
    q = {(a, b): quad(a, b) for a in ("ex", "ey") for b in ("ex", "ey")}
    d = sums.withColumns({f"_q{a}{b}_{p}": q[a, b][k] for a in ("ex", "ey") for b in ("ex", "ey") for k, p in enumerate(("re", "im"))})
    c = F.col
    rxx, ryy = c("ex_ex_re") - c("_qexex_re"), c("ey_ey_re") - c("_qeyey_re")
    xr, xi = c("ex_ey_re") - c("_qexey_re"), c("ex_ey_im") - c("_qexey_im")
    w1, w2 = -le / ln, ln / le

    def follow(w: Column) -> Column:
        see = c("ex_ex_re") + w * w * c("ey_ey_re") + 2 * w * c("ex_ey_re")
        return F.try_divide(c("_qexex_re") + w * w * c("_qeyey_re") + w * (c("_qexey_re") + c("_qeyex_re")), see)
    d = d.withColumns({"r2": F.try_divide(xr * xr + xi * xi, rxx * ryy), "g": F.try_divide(F.sqrt(xr * xr + xi * xi), rxx), "gr": F.try_divide(xr, rxx),
                       "m1": follow(w1), "m2": follow(w2), "c2": F.try_divide(c("ex_ey_re") ** 2 + c("ex_ey_im") ** 2, c("ex_ex_re") * c("ey_ey_re"))})
    return d.groupBy(*keys).agg(F.median("r2").alias("coh_r"), F.median("g").alias("gain"), F.signum(F.median("gr")).alias("s_obs"), F.median("m1").alias("mcoh_diff"),
                                F.median("m2").alias("mcoh_sum"), F.median("c2").alias("coh_ex_ey"), F.count(F.lit(1)).alias("n_harmonics"))


def mean_coherence(sums: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Whole-record coherence: the mean over harmonics of the summed cross spectra of two channels."""
    g2 = F.try_divide(F.col(f"{a}_{b}_re") ** 2 + F.col(f"{a}_{b}_im") ** 2, F.col(f"{a}_{a}_re") * F.col(f"{b}_{b}_re"))
    return sums.withColumn("_g", g2).groupBy(*keys).agg(F.avg("_g").alias("coh"), F.min("n").alias("n_segments"))


def fall(fc: DataFrame, keys: list[str], lo: tuple[int, int], hi: tuple[int, int]) -> DataFrame:
    """Decades of fall between two bands of harmonics of the mean segment power."""
    p = fc.groupBy(*keys, "f").agg(F.avg(F.col("re") ** 2 + F.col("im") ** 2).alias("p"))
    band = lambda b: F.median(F.when((F.col("f") >= b[0]) & (F.col("f") <= b[1]), F.col("p")))
    return p.groupBy(*keys).agg((F.log10(band(lo)) - F.log10(band(hi))).alias("decades_of_fall"))


def band_map(fc: DataFrame, keys: list[str], bins: list[tuple[int, int]]) -> DataFrame:
    """Mean power density per window and log-period bin in dB: `bins` are harmonic ranges."""
    arr = F.array(*[F.struct(F.lit(k).alias("bin"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(bins)])
    d = fc.withColumn("b_", F.explode(arr)).where((F.col("f") >= F.col("b_.a")) & (F.col("f") <= F.col("b_.b")))
    return d.groupBy(*keys, "seg", "chan", F.col("b_.bin").alias("bin")).agg(F.avg(F.col("re") ** 2 + F.col("im") ** 2).alias("_p")).select(
        *keys, "seg", "chan", "bin", F.when(F.col("_p") > 1e-12, 10 * F.log10("_p")).alias("db"))


def away_from_median(maps: DataFrame, keys: list[str], db: float = 10.0) -> DataFrame:
    """Median level of each map line and the share of windows more than `db` below or above it."""
    maps = maps.where(F.col("db").isNotNull())
    med = maps.groupBy(*keys).agg(F.median("db").alias("median_db"))
    d = maps.join(med, keys)
    return d.groupBy(*keys).agg(F.first("median_db").alias("median_db"), F.avg((F.col("db") < F.col("median_db") - db).cast("double")).alias("below"),
                                F.avg((F.col("db") > F.col("median_db") + db).cast("double")).alias("above"), F.count(F.lit(1)).alias("windows"))

