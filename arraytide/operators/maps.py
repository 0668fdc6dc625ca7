"""Coherence maps by levels of window length, and spectra of the longest finite run of a channel.

Long periods need long segments, so a map is made on a ladder of levels whose segment and window grow together (`estimate.map_levels`). The
ladder is a function of the sampling rate alone and is added to every sample as columns, so levels of all rates run through one plan. A segment is
gathered and transformed once, whatever number of windows it lies in; a window is the sum of its segments. Nothing is grouped by station alone.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import kernels
from .blocks import BLK, block_of
from .estimate import map_levels
from .hours import complete
from .islands import RUN_BLOCK, runs

# fixed values
MAP_PAIRS = {"hx_ey": ("hx", "ey"), "hy_ex": ("hy", "ex"), "hx_hy": ("hx", "hy"), "ex_ey": ("ex", "ey")}
PER_DECADE = 8
RUN_SEGMENT, RUN_LEAST = 4096, 16
FALL_FROM_HZ, FALL_TO_HZ, FALL_OF_RATE = 1e-3, 3.0, 0.4
POWER_BAND_S = (80.0, 120.0)


def _ceil_div(a: Column, b: Column) -> Column:
    return (-F.floor(-a.cast("double") / b)).cast("bigint")


def _floor_div(a: Column, b: Column) -> Column:
    return F.floor(a.cast("double") / b).cast("bigint")


def _numbers(lo: Column, hi: Column) -> Column:
    """lo, lo + 1, ... hi; nothing where hi is smaller."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def _spectra_of(chans: list[str]):
    """A pandas UDF over one column of arrays a channel: the spectrum without its constant, NULL where the array is."""
    def transform(*cols: pd.Series) -> pd.DataFrame:
        out = {}
        for name, col in zip(chans, cols, strict=True):
            re, im = np.empty(len(col), object), np.empty(len(col), object)
            size = np.array([-1 if v is None else len(v) for v in col])
            for n in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == n)
                z = kernels.spectra(np.stack([np.asarray(col.iloc[i], float) for i in rows]), int(n))[:, 0, 1:]
                for i, row in zip(rows, z, strict=True):
                    re[i], im[i] = row.real, row.imag
            out[f"{name}_re"], out[f"{name}_im"] = re, im
        return pd.DataFrame(out)
    return F.pandas_udf(transform, ", ".join(f"{c}_{p} array<double>" for c in chans for p in ("re", "im"))).asNondeterministic()


def _ladder(d: DataFrame, rate: str, ladder: dict) -> DataFrame:
    """`d` once per level, lengths in samples: _seg, _hop, _win, _step, _per segments a window, _nb bins."""
    fs = F.col(rate)
    d = map_levels(d, rate, **ladder).withColumns({
        "_seg": F.col("segment"), "_hop": _floor_div(F.col("segment"), F.lit(2)), "_win": F.round(F.col("window_s") * fs).cast("bigint"), "_step": F.round(F.col("level_step_s") * fs).cast("bigint")})
    return d.where("_win >= _seg").withColumn("_per", _floor_div(F.col("_win") - F.col("_seg"), F.col("_hop")) + 1)


def _bin(f: Column, rate: str, per_decade: int) -> tuple[Column, Column]:
    """(bin, number of bins) of the period of a harmonic between the level's shortest and longest period."""
    c = F.col
    nb = F.greatest(F.round(F.log10(c("to_s") / c("from_s")) * per_decade).cast("int"), F.lit(1))
    return F.floor(F.log(c("_seg") / (f * c(rate)) / c("from_s")) / F.log(c("to_s") / c("from_s")) * nb + 1e-9).cast("int"), nb


def coherence_map(samples: DataFrame, keys: list[str], pos: str, rate: str = "fs_hz", pairs: dict[str, tuple[str, str]] | None = None,
                  per_decade: int = PER_DECADE, **ladder) -> DataFrame:
    """(keys, rate, pair, level, window_s, level_step_s, win, t_s, bin, period_s, coh): squared Welch coherence of every window, meant over bins of
    log period.

    `rate` is a column, one value a record; `pos` counts samples. Window `win` of a level starts at sample win * step of the axis and is listed where
    it lies inside the record; t_s is its middle. A window with a missing sample in either channel has NULL in every bin; bins that hold no harmonic of
    the level's segment are not listed; harmonics without power are left out of their bin. `ladder` goes to `map_levels`.
    """
    pairs = pairs or MAP_PAIRS
    chans = sorted({c for p in pairs.values() for c in p})
    c, by = F.col, [*keys, rate, "level"]
    t = samples.select(*keys, rate, F.col(pos).cast("bigint").alias("_p"), *[c(x).cast("double").alias(x) for x in chans])
    lv = _ladder(t, rate, ladder)
    k = _numbers(_floor_div(c("_p") - c("_win"), c("_step")) + 1, _floor_div(c("_p"), c("_step")))

    def starts(w: Column) -> Column:
        x = c("_p") - w * c("_step")
        s = _numbers(F.greatest(_floor_div(x - c("_seg"), c("_hop")) + 1, F.lit(0)), F.least(_floor_div(x, c("_hop")), c("_per") - 1))
        return F.transform(s, lambda n: w * c("_step") + n * c("_hop"))
    # windows that meet in a segment name it once
    seg = lv.withColumn("_start", F.explode(F.array_distinct(F.flatten(F.transform(k, starts)))))
    geo = ["from_s", "to_s", "_seg", "_hop", "_win", "_step", "_per"]  # functions of rate and level
    g = seg.groupBy(*by, *geo, "_start").agg(F.array_sort(F.collect_list(F.struct("_p", *chans))).alias("_a"), F.count(F.lit(1)).alias("_n"))
    z = g.where("_n = _seg").select(*by, *geo, "_start", *[complete(c(f"_a.{x}")).alias(x) for x in chans])
    parts = [f"{x}_{p}" for x in chans for p in ("re", "im")]
    z = z.withColumn("_z", _spectra_of(chans)(*chans)).drop(*chans)
    # the windows of a segment, then its harmonics inside the level's band
    off = lambda w: c("_start") - w * c("_step")
    wins = F.filter(_numbers(_ceil_div(c("_start") + c("_seg") - c("_win"), c("_step")), _floor_div(c("_start"), c("_step"))),
                    lambda w: (F.pmod(off(w), c("_hop")) == 0) & (off(w) < c("_per") * c("_hop")))
    f_lo, f_hi = _floor_div(c("_seg"), c(rate) * c("to_s")), F.least(_ceil_div(c("_seg"), c(rate) * c("from_s")), c("_hop"))
    z = z.withColumn("f", F.explode(_numbers(F.greatest(f_lo, F.lit(1)), f_hi)))
    b, nb = _bin(c("f"), rate, per_decade)
    z = z.withColumn("bin", b).where((c("bin") >= 0) & (c("bin") < nb))
    z = z.select(*by, "_per", "f", "bin", wins.alias("_w"), *[F.get(f"_z.{n}", (c("f") - 1).cast("int")).alias(n) for n in parts]).withColumn("win", F.explode("_w"))
    sums = []
    for name, (a, e) in pairs.items():
        both = lambda x: F.sum(F.when(c(f"{a}_re").isNotNull() & c(f"{e}_re").isNotNull(), x))  # noqa: B023, E731
        sums += [both(c(f"{a}_re") * c(f"{e}_re") + c(f"{a}_im") * c(f"{e}_im")).alias(f"{name}_xr"), both(c(f"{a}_im") * c(f"{e}_re") - c(f"{a}_re") * c(f"{e}_im")).alias(f"{name}_xi"),
                 both(c(f"{a}_re") ** 2 + c(f"{a}_im") ** 2).alias(f"{name}_pa"), both(c(f"{e}_re") ** 2 + c(f"{e}_im") ** 2).alias(f"{name}_pb")]
    s = z.groupBy(*by, "win", "bin", "f").agg(*sums)
    g2 = lambda n: F.try_divide(c(f"{n}_xr") ** 2 + c(f"{n}_xi") ** 2, c(f"{n}_pa") * c(f"{n}_pb"))
    s = s.groupBy(*by, "win", "bin").agg(*[F.avg(g2(n)).alias(n) for n in pairs])
    # a window counts for a pair only where no sample of it is missing, the ones behind its last segment included
    full = lv.withColumn("win", F.explode(k)).groupBy(*by, "win", "_win").agg(*[F.count_if(c(a).isNotNull() & c(e).isNotNull()).alias(f"_n_{n}") for n, (a, e) in pairs.items()])
    s = s.join(full, [*by, "win"]).select(*by, "win", "bin", F.explode(F.array(*[
        F.struct(F.lit(n).alias("pair"), F.when(c(f"_n_{n}") == c("_win"), c(n)).alias("coh")) for n in pairs])).alias("_c")).select(*by, "win", "bin", "_c.pair", "_c.coh")
    span = t.groupBy(*keys, rate).agg(F.min("_p").alias("_first"), (F.max("_p") + 1).alias("_end"))
    w = _ladder(span, rate, ladder).withColumn("win", F.explode(_numbers(_ceil_div(c("_first"), c("_step")), _floor_div(c("_end") - c("_win"), c("_step")))))
    w = w.withColumn("pair", F.explode(F.array(*[F.lit(n) for n in pairs])))
    held = _ladder(t.select(rate).distinct(), rate, ladder).withColumn("_f", F.explode(F.sequence(F.lit(1).cast("bigint"), c("_hop"))))
    b, nb = _bin(c("_f"), rate, per_decade)
    held = held.withColumns({"bin": b, "period_s": c("from_s") * F.pow(c("to_s") / c("from_s"), (b + 0.5) / nb)}).where((b >= 0) & (b < nb)).select(rate, "level", "bin", "period_s").distinct()
    w = w.join(held, [rate, "level"]).join(s, [*by, "win", "bin", "pair"], "left")
    return w.select(*keys, rate, "pair", "level", "window_s", "level_step_s", "win", ((c("win") * c("_step") + c("_win") / 2) / c(rate)).alias("t_s"), "bin", "period_s", "coh")


def band_lines(cmap: DataFrame, keys: list[str], bands: dict[str, tuple[float, float]], rate: str = "fs_hz") -> DataFrame:
    """(keys, rate, pair, band, win, t_s, coh): one line per band of periods on the times of level 0, the mean of every level that reaches the band.

    A coarse level answers for a time with its first window whose middle is not earlier, or its last one. Windows are regular, so that window's
    number follows from the time and the levels meet on it.
    """
    c, by = F.col, [*keys, rate, "pair"]
    b = F.array(*[F.struct(F.lit(n).alias("band"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")) for n, (lo, hi) in bands.items()])
    m = cmap.withColumn("_b", F.explode(b)).where((c("period_s") >= c("_b.lo")) & (c("period_s") <= c("_b.hi")))
    m = m.groupBy(*by, c("_b.band").alias("band"), "level", "win").agg(F.avg("coh").alias("_v"))
    there = cmap.groupBy(*by, "level").agg(F.min("win").alias("_lo"), F.max("win").alias("_hi"), F.first("window_s").alias("_ws"), F.first("level_step_s").alias("_ss"))
    base = cmap.where("level = 0").select(*by, c("win").alias("_base"), "t_s").distinct()
    at = F.least(F.greatest(F.ceil((c("t_s") - c("_ws") / 2) / c("_ss") - 1e-9), c("_lo")), c("_hi")).cast("bigint")
    d = base.join(there, by).select(*by, "_base", "t_s", "level", at.alias("win")).join(m, [*by, "level", "win"])
    return d.groupBy(*by, "band", c("_base").alias("win"), "t_s").agg(F.avg("_v").alias("coh"))


def longest_runs(samples: DataFrame, keys: list[str], pos: str, chans: list[str], block: int = RUN_BLOCK) -> DataFrame:
    """(keys, chan, run_start, run_end, run_len): the longest run of samples that are there, the earliest of equals."""
    r = runs(_long(samples, keys, pos, chans), [*keys, "chan"], pos, block=block)
    b = r.groupBy(*keys, "chan").agg(F.max(F.struct("run_len", (-F.col("run_start")).alias("_s"))).alias("_b"))
    return b.select(*keys, "chan", (-F.col("_b._s")).alias("run_start"), (F.col("_b.run_len") - F.col("_b._s") - 1).alias("run_end"), F.col("_b.run_len").alias("run_len"))


def _long(samples: DataFrame, keys: list[str], pos: str, chans: list[str]) -> DataFrame:
    d = samples.select(*keys, F.col(pos).cast("bigint").alias(pos), F.explode(F.array(*[F.struct(F.lit(x).alias("chan"), F.col(x).cast("double").alias("x")) for x in chans])).alias("_c"))
    return d.select(*keys, pos, "_c.chan", "_c.x").where(F.col("x").isNotNull() & ~F.isnan("x"))


def run_spectra(samples: DataFrame, keys: list[str], pos: str, chans: list[str], fs: float = 1.0, nperseg: int = RUN_SEGMENT, block: int = RUN_BLOCK) -> DataFrame:
    """(keys, chan, run_len, n_segments, f_hz, power): one-sided Welch density of the longest finite run of every channel, its segments counted from
    the run's first sample; a run shorter than a segment is one segment, a run under 16 samples has no spectrum."""
    c = F.col
    best = longest_runs(samples, keys, pos, chans, block).where(c("run_len") >= RUN_LEAST)
    # a run meets its samples block by block, so a long record is not one key
    best = best.withColumn(BLK, F.explode(F.sequence(block_of("run_start", block), block_of("run_end", block))))
    d = _long(samples, keys, pos, chans).withColumn(BLK, block_of(pos, block)).join(best, [*keys, "chan", BLK]).where(c(pos).between(c("run_start"), c("run_end")))
    d = d.withColumns({"_n": F.least(c("run_len"), F.lit(nperseg)), "_x": c(pos) - c("run_start")})
    d = d.withColumn("_hop", c("_n") - _floor_div(c("_n"), F.lit(2)))
    last = _floor_div(c("run_len") - c("_n"), c("_hop"))
    d = d.withColumn("_seg", F.explode(_numbers(F.greatest(_floor_div(c("_x") - c("_n"), c("_hop")) + 1, F.lit(0)), F.least(_floor_div(c("_x"), c("_hop")), last))))
    g = d.groupBy(*keys, "chan", "run_len", "_n", "_seg").agg(F.array_sort(F.collect_list(F.struct(c("_x").alias("p"), "x"))).alias("_a"))
    z = g.select(*keys, "chan", "run_len", "_n", "_seg", _spectra_of(["x"])(c("_a.x")).alias("_z")).select(
        *keys, "chan", "run_len", "_n", "_seg", F.posexplode(F.arrays_zip("_z.x_re", "_z.x_im")).alias("_k", "_v"))
    p = z.groupBy(*keys, "chan", "run_len", "_n", (c("_k") + 1).alias("_f")).agg(F.avg(c("_v.x_re") ** 2 + c("_v.x_im") ** 2).alias("_p"), F.count(F.lit(1)).alias("n_segments"))
    # the squares of a Hann window of n points sum to 3 n / 8
    density = c("_p") / (F.lit(fs) * c("_n") * 0.375) * F.when(c("_f") * 2 == c("_n"), 1.0).otherwise(2.0)
    return p.select(*keys, "chan", "run_len", "n_segments", (c("_f") * F.lit(fs) / c("_n")).alias("f_hz"), density.alias("power"))


def decades_of_fall(spectra: DataFrame, keys: list[str], fs: float = 1.0, from_hz: float = FALL_FROM_HZ, to_hz: float | None = None,
                    power_band_s: tuple[float, float] = POWER_BAND_S) -> DataFrame:
    """(keys, from_hz, to_hz, decades_of_fall, band_power) of power spectra: the fall between medians just round the low and just under the high
    frequency, the latter no higher than four tenths of the rate; NULL where a band holds no frequency."""
    hi = min(FALL_TO_HZ, FALL_OF_RATE * fs) if to_hz is None else to_hz
    f, p = F.col("f_hz"), F.col("power")
    mid = lambda a, b: F.median(F.when((f >= a) & (f <= b), p))
    fall = F.log10(mid(0.8 * from_hz, 1.2 * from_hz)) - F.log10(mid(0.8 * hi, hi))
    return spectra.groupBy(*keys).agg(F.lit(from_hz).alias("from_hz"), F.lit(hi).alias("to_hz"), fall.alias("decades_of_fall"), mid(1 / power_band_s[1], 1 / power_band_s[0]).alias("band_power"))
