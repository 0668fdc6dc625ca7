"""Time between records: the constant delay of a member behind its target, and the daily clock test against another station.

Records meet as bounded arrays: a window of a pair, or a day of one station with the same day of another and a halo on either side. Arrays of
whole blocks are made once per station and joined on (station, block); the halo is cut from the neighbouring blocks, so no sample is copied.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import kernels
from ..session import cut_lineage
from . import hours, islands, spectral, stretches
from .blocks import block_of

# fixed values
SHORT_BAND, LONG_BAND = (1 / 20.0, 1 / 5.0), (1 / 200.0, 1 / 20.0)
WINDOW_S, FALLBACK_S, MIN_WINDOWS, MAX_LAG_S = 2 * 86_400, 43_200, 2, 30
CLOCK_HALO_S, FIELD_TOLERANCE, LEAST_FIELD = 43_200, 0.20, 3600


def pair_runs(samples: DataFrame, pairs: DataFrame, site: str, pos: str, present: Column, block: int = islands.RUN_BLOCK) -> DataFrame:
    """(a, b, run_start, run_end, run_len): stretches of the axis on which both stations of a pair have every sample. Runs meet, not samples."""
    r = islands.runs(samples, [site], pos, present, block=block).select(F.col(site), "run_start", "run_end")
    x = r.select(F.col(site).alias("a"), F.col("run_start").alias("s1"), F.col("run_end").alias("e1"))
    y = r.select(F.col(site).alias("b"), F.col("run_start").alias("s2"), F.col("run_end").alias("e2"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").where("s1 <= e2 and s2 <= e1")
    t = both.select("a", "b", F.greatest("s1", "s2").alias("run_start"), F.least("e1", "e2").alias("run_end"))
    return t.withColumn("run_len", F.col("run_end") - F.col("run_start") + 1)


def window_arrays(samples: DataFrame, windows: DataFrame, site: str, pos: str, chans: tuple[str, ...], win: int) -> DataFrame:
    """(a, b, w_start, chan, x, y): both stations' samples of every window. A window lies in two blocks of `win` positions at most."""
    held = samples.groupBy(F.col(site).alias("_site"), block_of(pos, win).alias("_slot")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).cast("bigint").alias("p"), *[F.col(c).cast("double").alias(c) for c in chans]))).alias("_a"))
    t = windows.select("a", "b", "w_start").withColumn("_slot", block_of("w_start", win))
    for end in ("a", "b"):
        for k in (0, 1):
            part = held.select(F.col("_site").alias(end), (F.col("_slot") - k).alias("_slot"), F.col("_a").alias(f"_{end}{k}"))
            t = t.join(part, [end, "_slot"], "left")
        there = F.filter(F.concat(*[F.coalesce(f"_{end}{k}", F.array().cast(held.schema["_a"].dataType)) for k in (0, 1)]),
                         lambda v: (v["p"] >= F.col("w_start")) & (v["p"] < F.col("w_start") + win))
        t = t.withColumn(f"_{end}", there)
    c = F.explode(F.array(*[F.struct(F.lit(n).alias("chan"), F.col(f"_a.{n}").alias("x"), F.col(f"_b.{n}").alias("y")) for n in chans]))
    return t.where((F.size("_a") == win) & (F.size("_b") == win)).select("a", "b", "w_start", c.alias("c")).select("a", "b", "w_start", "c.*")


def _tried(samples: DataFrame, pairs: DataFrame, site: str, pos: str, chans: tuple[str, ...], win: int, max_lag: int, short, long, fs: float,
           min_corr: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Window lags (a, b, w_start, chan, lag_s, r) of the short band, and (a, b, long_r): the median peak of the long band in the same windows.

    Every disjoint whole window that both records hold is looked at.
    """
    present = F.lit(True)
    for c in chans:
        present = present & F.col(c).isNotNull()
    runs = pair_runs(samples, pairs, site, pos, present, block)
    arrays = window_arrays(samples, stretches.run_windows(runs, ["a", "b"], win), site, pos, chans, win)
    keep = ["a", "b", "w_start", "chan"]
    # one row per window and channel, read by every later step: the windows are not cut and filtered again
    low = cut_lineage(spectral.window_lags(arrays, keep, "x", "y", max_lag, long, fs))
    return (cut_lineage(spectral.window_lags(arrays, keep, "x", "y", max_lag, short, fs)),
            low.where(F.col("r") >= min_corr).groupBy("a", "b").agg(F.median("r").alias("long_r")))


def member_lags(samples: DataFrame, pairs: DataFrame, site: str, pos: str, chans: tuple[str, ...] = ("hx", "hy"), fs: float = 1.0, win: int = WINDOW_S,
                fallback: int | None = FALLBACK_S, min_windows: int = MIN_WINDOWS, max_lag: int = MAX_LAG_S, short=SHORT_BAND,
                long=LONG_BAND, min_corr: float = spectral.LAG_MIN_CORR, max_spread: float = spectral.LAG_MAX_SPREAD, min_long: float = spectral.LAG_MIN_LONG,
                block: int = islands.RUN_BLOCK) -> DataFrame:
    """(a, b, lag_s, spread, n_windows, win, note): how far b is behind a, or 0 with the gate that refused it; one row per named pair.

    Every whole window of `win` samples in the stretches that both records hold is measured. Only pairs with fewer than `min_windows` usable ones are tried
    again with `fallback` samples, and keep that form where it finds more. The lag has to be measured in a window (peak `min_corr`), to be one
    constant (range of the window medians `max_spread`) and to belong to records that follow each other in the long band (`min_long`).
    """
    how = (max_lag, short, long, fs, min_corr, block)
    # runs, windows and bands of both forms read the record, which may be a long plan
    samples = cut_lineage(samples.select(site, pos, *chans))
    p = pairs.select("a", "b").distinct()
    low, low_r = _tried(samples, p, site, pos, chans, win, *how)
    usable = lambda t, name: t.where(F.col("r") >= min_corr).groupBy("a", "b").agg(F.countDistinct("w_start").alias(name))
    n = p.join(usable(low, "n1"), ["a", "b"], "left").fillna(0, ["n1"])
    lags, long_r = low.withColumn("win", F.lit(win)), low_r.withColumn("win", F.lit(win))
    if fallback:
        again = n.where(F.col("n1") < min_windows).select("a", "b")
        other, other_r = _tried(samples, again, site, pos, chans, fallback, *how)
        n = n.join(usable(other, "n2"), ["a", "b"], "left").fillna(0, ["n2"])
        lags = lags.unionByName(other.withColumn("win", F.lit(fallback)))
        long_r = long_r.unionByName(other_r.withColumn("win", F.lit(fallback)))
        form = n.select("a", "b", F.when((F.col("n1") < min_windows) & (F.col("n2") > F.col("n1")), fallback).otherwise(win).alias("win"))
    else:
        form = n.select("a", "b", F.lit(win).alias("win"))
    key = ["a", "b", "win"]
    got = spectral.lag_verdict(form.join(lags, key, "left").select(*key, "w_start", "lag_s", "r"), key, "w_start", form.join(long_r, key, "left"), min_corr, max_spread, min_long)
    return got.select("a", "b", "lag_s", "spread", "n_windows", "win", "note")


def daily_field(samples: DataFrame, keys: list[str], pos: str, model: DataFrame, day: int = hours.DAY_S, least: int = LEAST_FIELD) -> DataFrame:
    """(keys, day, f_ratio): the day's median total field over the station's `model_f`; a day with fewer than `least` whole samples has none."""
    f = F.sqrt(F.col("hx") ** 2 + F.col("hy") ** 2 + F.col("hz") ** 2)
    d = samples.select(*keys, block_of(pos, day).alias("day"), f.alias("_f")).groupBy(*keys, "day").agg(F.median("_f").alias("_m"), F.count("_f").alias("_n"))
    return d.join(model, keys).select(*keys, "day", F.when(F.col("_n") >= least, F.col("_m") / F.col("model_f")).alias("f_ratio"))


def clock_days(samples: DataFrame, pairs: DataFrame, site: str, pos: str, chan: str = "hx", day: int = hours.DAY_S, halo: int = CLOCK_HALO_S, band=SHORT_BAND,
               fs: float = 1.0, min_finite: float = hours.MIN_FINITE, edge: float = spectral.CLOCK_EDGE) -> DataFrame:
    """(site, ref, day, lag_s, r, ratio, edge): every whole day of `site` in the same day of `ref` with `halo` samples more on either side.

    `halo` is at most a day. Days that the reference does not cover, halo included, are not offered; a day too much of which is missing on either
    side has no row. A positive lag means that the station's samples must move later. `band` None takes the samples as they are.
    """
    held = spectral.as_arrays(samples, [site], pos, [chan], day, whole=False).where(F.col("n") == day).select(F.col(site).alias("_site"), "seg", F.col(chan).alias("_x"))
    t = pairs.select("site", "ref").join(held.withColumnsRenamed({"_site": "site", "_x": "x"}), "site")
    for name, k in (("before", 1), ("middle", 0), ("after", -1)):
        t = t.join(held.select(F.col("_site").alias("ref"), (F.col("seg") + k).alias("seg"), F.col("_x").alias(name)), ["ref", "seg"])
    t = t.select("site", "ref", F.col("seg").alias("day"), "x", F.concat(F.slice("before", day - halo + 1, halo), "middle", F.slice("after", 1, halo)).alias("y"))
    made = ["lag_s", "r", "ratio", "at"]

    def ready(col: pd.Series, coef) -> tuple[np.ndarray, np.ndarray]:
        x = np.stack([np.array([np.nan if v is None else v for v in a], float) for a in col])
        clean = np.stack([kernels.despiked(r) for r in x]) if coef is not None else x
        fine = np.isfinite(clean)
        ok = (fine.mean(axis=1) >= min_finite) & (fine.sum(axis=1) >= hours.LEAST_SAMPLES)
        out = np.zeros_like(x)
        if ok.any():
            y = np.stack([kernels.bridged(r) for r in clean[ok]])
            y = y - y.mean(axis=1, keepdims=True)
            out[ok] = kernels.filtfilt(*coef, y) if coef is not None else y
        return out, ok & np.isfinite(out).all(axis=1)

    def run(batches):
        coef = kernels.butter(4, band, fs, "band") if band else None
        for pdf in batches:
            if not len(pdf):
                continue
            (x, ok), (y, fine) = ready(pdf["x"], coef), ready(pdf["y"], coef)
            both = ok & fine
            out = pdf.loc[both, ["site", "ref", "day"]].copy()
            peak = kernels.halo_peaks(x[both], y[both], halo) if both.any() else {k: np.empty(0) for k in ("lag", "r", "ratio", "at")}
            for k, v in zip(made, (peak["lag"] / fs, peak["r"], peak["ratio"], peak["at"]), strict=True):
                out[k] = v
            yield out

    kind = t.schema["site"].dataType.simpleString()
    got = t.mapInPandas(run, f"site {kind}, ref {kind}, day bigint, " + ", ".join(f"{m} double" for m in made))
    return got.select("site", "ref", "day", "lag_s", "r", "ratio", (F.abs("at") >= edge * halo).alias("edge"))


def clock_test(samples: DataFrame, pairs: DataFrame, model: DataFrame, site: str, pos: str, min_days: int = spectral.CLOCK_MIN_DAYS,
               limit: float = spectral.CLOCK_PASS, day: int = hours.DAY_S, least: int = LEAST_FIELD, **how) -> DataFrame:
    """(site, n_offered, n_days, judged, median_lag_s, ok) over the days whose measured field is near the station's model."""
    days = clock_days(samples, pairs, site, pos, day=day, **how)
    field = daily_field(samples, [site], pos, model, day, least).withColumnRenamed(site, "site")
    return spectral.clock_verdict(days.join(field, ["site", "day"], "left"), ["site"], min_days, limit)
