"""Coherence of bounded stretches of a record: the hour score table that ranks hours, and the table of lines by day.

A stretch (an hour, a day) is one array row per channel. Its half-overlapping segments are transformed together and become rows (keys, f); powers
and cross powers are plain sums of them, so nothing but the arrays themselves is shuffled. A stretch is refused on its own samples: an hour with any
missing sample of a pair has no score on that pair, a day with less than `min_finite` of any channel is a gap.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import kernels
from . import spectral

# fixed values
HOUR_S, SCORE_SEGMENT_S, SCORE_BAND_S = 3600, 1024, (20.0, 200.0)
DAY_S, DAY_SEGMENT_S, DAY_OVERLAP_S, DAY_BAND_S = 86_400, 4096, 2048, (20.0, 200.0)
HIGHPASS_S, MIN_FINITE, MIN_DAY_S, LEAST_SAMPLES = 3000.0, 0.8, 6 * 3600, 16
SCORE_PAIRS = {"coh_xy": ("ex", "hy"), "coh_yx": ("ey", "hx")}
LINE_PAIRS = {"coh_ex_hy": ("ex", "hy"), "coh_ey_hx": ("ey", "hx"), "coh_ex_ey": ("ex", "ey")}


def complete(array: Column) -> Column:
    """The array where it has no NULL in it, else NULL."""
    return F.when(~F.exists(array, lambda v: v.isNull()), array)


def harmonics(nperseg: int, band_s: tuple[float, float], fs: float) -> tuple[int, int]:
    """First and last harmonic whose period lies strictly inside the band."""
    inside = [f for f in range(1, nperseg // 2 + 1) if 1.0 / band_s[1] < f * fs / nperseg < 1.0 / band_s[0]]
    return (inside[0], inside[-1]) if inside else (1, 0)


def coherences(arrays: DataFrame, keys: list[str], pairs: dict[str, tuple[str, str]], nperseg: int, overlap: int, band_s: tuple[float, float],
               fs: float = 1.0) -> DataFrame:
    """(keys, <pair>...): the median squared Welch coherence over a band of periods of every row of arrays; NULL where a channel of the pair is NULL.

    Rows whose arrays are shorter than a segment, and rows without a harmonic in the band, are left out.
    """
    chans = sorted({c for p in pairs.values() for c in p})
    lo, hi = harmonics(nperseg, band_s, fs)
    step = nperseg - overlap
    size = F.greatest(*[F.when(F.col(c).isNotNull(), F.size(c)) for c in chans], F.lit(0))
    d = arrays.where((size >= nperseg) & F.lit(lo <= hi)).withColumn("_k", F.explode(F.sequence(F.lit(0), F.floor((size - nperseg) / step).cast("int"))))
    d = d.select(*keys, *[F.slice(c, F.col("_k") * step + 1, nperseg).alias(c) for c in chans])

    def transform(*cols: pd.Series) -> pd.DataFrame:
        out = {}
        for name, col in zip(chans, cols, strict=True):
            there = np.flatnonzero(col.notna().to_numpy())
            re, im = np.empty(len(col), object), np.empty(len(col), object)
            if len(there):
                z = kernels.spectra(np.stack([np.asarray(col.iloc[i], float) for i in there]), nperseg, 0)[:, 0, lo: hi + 1]
                for i, row in zip(there, z, strict=True):
                    re[i], im[i] = row.real, row.imag
            out[f"{name}_re"], out[f"{name}_im"] = re, im
        return pd.DataFrame(out)

    parts = [f"{c}_{p}" for c in chans for p in ("re", "im")]
    fft = F.pandas_udf(transform, ", ".join(f"{n} array<double>" for n in parts)).asNondeterministic()
    z = d.select(*keys, fft(*chans).alias("z")).withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(max(hi - lo, 0)))))
    z = z.select(*keys, "f", *[F.get(f"z.{n}", F.col("f")).alias(n) for n in parts])
    c, sums = F.col, []
    for name, (a, b) in pairs.items():
        both = lambda x: F.sum(F.when(c(f"{a}_re").isNotNull() & c(f"{b}_re").isNotNull(), x))  # noqa: B023
        sums += [both(c(f"{a}_re") * c(f"{b}_re") + c(f"{a}_im") * c(f"{b}_im")).alias(f"{name}_xr"), both(c(f"{a}_im") * c(f"{b}_re") - c(f"{a}_re") * c(f"{b}_im")).alias(f"{name}_xi"),
                 both(c(f"{a}_re") ** 2 + c(f"{a}_im") ** 2).alias(f"{name}_pa"), both(c(f"{b}_re") ** 2 + c(f"{b}_im") ** 2).alias(f"{name}_pb")]
    s = z.groupBy(*keys, "f").agg(*sums)
    g2 = {n: F.try_divide(c(f"{n}_xr") ** 2 + c(f"{n}_xi") ** 2, c(f"{n}_pa") * c(f"{n}_pb")) for n in pairs}
    return s.groupBy(*keys).agg(*[F.median(g).alias(n) for n, g in g2.items()])


def hour_scores(samples: DataFrame, keys: list[str], pos: str, hour: int = HOUR_S, nperseg: int = SCORE_SEGMENT_S, band_s: tuple[float, float] = SCORE_BAND_S,
                fs: float = 1.0, pairs: dict[str, tuple[str, str]] | None = None, digits: int = 6) -> DataFrame:
    """(keys, hour, <pair>..., score): one row per whole hour of the axis; `hour` positions make one, numbered from position 0.

    A pair with a missing sample in the hour has no score; `score` is the mean of the pairs that have one. Everything is rounded before it is
    ranked, so a table read back finds the same hours.
    """
    pairs = pairs or SCORE_PAIRS
    chans = sorted({c for p in pairs.values() for c in p})
    whole = spectral.as_arrays(samples, keys, pos, chans, hour, whole=False).where(F.col("n") == hour).withColumnRenamed("seg", "hour")
    held = whole.select(*keys, "hour", *[complete(F.col(c)).alias(c) for c in chans])
    coh = coherences(held, [*keys, "hour"], pairs, nperseg, nperseg // 2, band_s, fs)
    t = whole.select(*keys, "hour").join(coh, [*keys, "hour"], "left").select(*keys, "hour", *[F.round(n, digits).alias(n) for n in pairs])
    there = [F.col(n).isNotNull().cast("int") for n in pairs]
    total = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in pairs), F.lit(0.0))
    return t.withColumn("score", F.round(F.try_divide(total, sum(there[1:], there[0])) + F.lit(2e-10), digits))


def prepared(arrays: DataFrame, chans: list[str], fs: float = 1.0, highpass_s: float | None = HIGHPASS_S, min_finite: float = MIN_FINITE,
             least: int = LEAST_SAMPLES) -> DataFrame:
    """`arrays` with every channel ready for a spectrum: despiked, gaps bridged, less its mean and high-passed; NULL where too little of it is finite.

    With `highpass_s` None the samples are taken as they are and gaps are bridged only.
    """
    coef = kernels.butter(2, [1.0 / highpass_s], fs, "high") if highpass_s else None

    def ready(col: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(col), dtype=object)
        for rows, x in ((np.flatnonzero(col.map(len) == n), n) for n in pd.unique(col.map(len))):
            x = np.stack([np.array([np.nan if v is None else v for v in col.iloc[i]], float) for i in rows])
            clean = np.stack([kernels.despiked(r) for r in x]) if coef else x
            fine = np.isfinite(clean)
            ok = (fine.mean(axis=1) >= min_finite) & (fine.sum(axis=1) >= least)
            if ok.any():
                y = np.stack([kernels.bridged(r) for r in clean[ok]])
                y = kernels.filtfilt(*coef, y - y.mean(axis=1, keepdims=True)) if coef else y
                for i, row in zip(rows[ok], y, strict=True):
                    out.iloc[i] = row if np.isfinite(row).all() else None
        return out

    # marked so that the optimiser neither repeats it nor moves it past the cutting into segments
    udf = F.pandas_udf(ready, "array<double>").asNondeterministic()
    return arrays.withColumns({c: udf(c) for c in chans})


def deviation(array: Column | str) -> Column:
    """Population standard deviation of an array."""
    def std(col: pd.Series) -> pd.Series:
        return col.map(lambda v: float(np.std(v)))
    return F.pandas_udf(std, "double")(array)


def daily_lines(samples: DataFrame, keys: list[str], pos: str, day: int = DAY_S, nperseg: int = DAY_SEGMENT_S, overlap: int = DAY_OVERLAP_S,
                band_s: tuple[float, float] = DAY_BAND_S, fs: float = 1.0, highpass_s: float | None = HIGHPASS_S, min_day: int = MIN_DAY_S, digits: int = 3) -> DataFrame:
    """(keys, day, n, coh_ex_hy, coh_ey_hx, coh_ex_ey, std_ex, std_ey): one row per day that holds `min_day` positions of the axis.

    A day with too few finite samples of any of the four channels is a gap: all its values are NULL.
    """
    chans = ["ex", "ey", "hx", "hy"]
    held = spectral.as_arrays(samples, keys, pos, chans, day, whole=False).where(F.col("n") >= min_day).withColumnRenamed("seg", "day")
    ready = prepared(held, chans, fs, highpass_s)
    fine = F.lit(True)
    for c in chans:
        fine = fine & F.col(c).isNotNull()
    ready = ready.withColumn("_fine", fine)
    coh = coherences(ready.where("_fine").select(*keys, "day", *chans), [*keys, "day"], LINE_PAIRS, nperseg, overlap, band_s, fs)
    stds = ready.where("_fine").select(*keys, "day", *[deviation(F.col(c)).alias(f"std_{c}") for c in ("ex", "ey")])
    out = held.select(*keys, "day", "n").join(stds.join(coh, [*keys, "day"], "left"), [*keys, "day"], "left")
    return out.select(*keys, "day", "n", *[F.round(F.col(c) + F.lit(2e-10), digits).alias(c) for c in (*LINE_PAIRS, "std_ex", "std_ey")])
