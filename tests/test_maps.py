"""Coherence maps and spectra of longest runs against plain numpy, with windows that no segment grid fits and gaps of every kind."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from arraytide.operators import maps

LADDER = dict(win_s=150, step_s=70, shortest_s=2.0, longest_s=100.0, first_segments=4, later_segments=6, factor=4)


def record(spark, x, y, t0=0, fs=1.0, site="a"):
    rows = [(site, i + t0, None if a != a else float(a), None if b != b else float(b), fs) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "site string, i long, x double, y double, fs_hz double")


def window_coherence(x, y, n):
    hop, w = n // 2, 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    at = range(0, len(x) - n + 1, hop)
    a, b = (np.array([np.fft.rfft((v[k:k + n] - v[k:k + n].mean()) * w) for k in at]) for v in (x, y))
    return (np.abs((a * b.conj()).sum(0)) ** 2 / ((np.abs(a) ** 2).sum(0) * (np.abs(b) ** 2).sum(0)))[1:]


def levels(fs):
    n0 = 2 ** int(np.log2(150 * fs / 4) + 1e-9)
    for k in range(1 + max(0, int(np.ceil(np.log(100 * fs / n0) / np.log(4) - 1e-9)))):
        n = n0 * 4 ** k
        win, step = (150, 70) if k == 0 else (np.floor(6 * n / fs), max(70, np.floor(n / fs / 2)))
        yield k, n, int(round(win * fs)), int(round(step * fs)), 2.0 if k == 0 else n / fs / 4, min(n / fs, 100.0)


def brute_map(x, y, t0, fs, per_decade):
    out = {}
    for k, n, win, step, lo, hi in levels(fs):
        nb = max(1, int(np.log10(hi / lo) * per_decade + 0.5))
        per = n / fs / np.arange(1, n // 2 + 1)
        which = np.floor(np.log(per / lo) / np.log(hi / lo) * nb + 1e-9).astype(int)
        for w in range(-(-t0 // step), (t0 + len(x) - win) // step + 1):
            a, b = x[w * step - t0:][:win], y[w * step - t0:][:win]
            c = window_coherence(a, b, n) if np.isfinite(a).all() and np.isfinite(b).all() else None
            for i in set(which[(which >= 0) & (which < nb)]):
                out[k, w, i] = None if c is None else c[which == i].mean()
    return out


@pytest.mark.parametrize("fs,t0", [(1.0, 0), (1.0, 137), (2.0, -60)])
def test_map_of_windows_off_the_segment_grid(spark, fs, t0):
    rng = np.random.default_rng(5)
    x = rng.normal(size=4200)
    y = x + rng.normal(size=4200)
    x[700], y[1250:1253] = np.nan, np.nan
    x[350 - t0 + 149] = np.nan  # in the last sample of a window, behind its last segment
    got = maps.coherence_map(record(spark, x, y, t0, fs), ["site"], "i", pairs={"xy": ("x", "y")}, **LADDER)
    want = brute_map(x, y, t0, fs, maps.PER_DECADE)
    rows = {(r.level, r.win, r.bin): r.coh for r in got.collect()}
    assert rows.keys() == want.keys()
    assert {k for k, v in rows.items() if v is None} == {k for k, v in want.items() if v is None}
    assert all(v is None or rows[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())
    assert any(v is not None for k, v in want.items() if k[0] == 1) and any(v is None for v in want.values())


def test_missing_rows_are_missing_samples_and_pairs_are_apart(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=600), rng.normal(size=600)
    full = record(spark, x, y)
    holed = full.where("i <> 300")
    null = full.withColumns({c: F.when(F.col("i") != 300, F.col(c)) for c in ("x", "y")})
    pairs = {"xy": ("x", "y"), "yy": ("y", "y")}
    a, b = ({(r.pair, r.level, r.win, r.bin): r.coh for r in maps.coherence_map(d, ["site"], "i", pairs=pairs, **LADDER).collect()} for d in (holed, null))
    assert a == b
    only = full.withColumn("x", F.when(F.col("i") != 300, F.col("x")))
    c = [r for r in maps.coherence_map(only, ["site"], "i", pairs=pairs, **LADDER).collect()]
    assert all(r.coh == pytest.approx(1.0) for r in c if r.pair == "yy") and any(r.coh is None for r in c if r.pair == "xy")
    assert maps.coherence_map(full.limit(0), ["site"], "i", pairs=pairs, **LADDER).collect() == []


def test_band_lines_take_the_next_coarse_window(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=2000)
    y = x + rng.normal(size=2000)
    y[900] = np.nan
    cmap = maps.coherence_map(record(spark, x, y), ["site"], "i", pairs={"xy": ("x", "y")}, **LADDER).cache()
    bands = {"short": (2.0, 20.0), "both": (10.0, 90.0), "none": (1e4, 1e5)}
    got = {(r.band, r.win): r.coh for r in maps.band_lines(cmap, ["site"], bands).collect()}
    m = cmap.toPandas()
    times = {k: g.drop_duplicates("win").sort_values("win") for k, g in m.groupby("level")}
    assert len(times) == 2
    for name, (lo, hi) in bands.items():
        lines = {k: g[(g.period_s >= lo) & (g.period_s <= hi)].groupby("win").coh.mean() for k, g in m.groupby("level")}
        for t, w in zip(times[0].t_s, times[0].win, strict=True):
            v = []
            for k, line in lines.items():
                at = min(np.searchsorted(times[k].t_s.to_numpy(), t), len(times[k]) - 1)
                if len(line):
                    v.append(line[times[k].win.iloc[at]])
            v = [a for a in v if a == a]
            have = got.get((name, w))
            assert have is None if not v else have == pytest.approx(np.mean(v))


def test_spectrum_of_the_longest_run_restarts_in_it(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=1000), np.cumsum(rng.normal(size=1000))
    x[[100, 333, 700]] = np.nan            # runs of 100, 232, 366, 299
    y[::50] = np.nan                       # all runs of 49
    d = record(spark, x, y)
    for block in (64, 365, 5000):
        runs = {r.chan: (r.run_start, r.run_end, r.run_len) for r in maps.longest_runs(d, ["site"], "i", ["x", "y"], block).collect()}
        assert runs == {"x": (334, 699, 366), "y": (1, 49, 49)}
        s = maps.run_spectra(d, ["site"], "i", ["x", "y"], fs=2.0, nperseg=128, block=block).toPandas()
        for chan, v, n in (("x", x[334:700], 128), ("y", y[1:50], 49)):
            hop, w = n - n // 2, 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
            z = np.array([np.fft.rfft((v[k:k + n] - v[k:k + n].mean()) * w) for k in range(0, len(v) - n + 1, hop)])
            p = (np.abs(z) ** 2).mean(0) / (2.0 * (w ** 2).sum())
            p[1:-1 if n % 2 == 0 else None] *= 2
            g = s[s.chan == chan].sort_values("f_hz")
            assert np.allclose(g.f_hz, np.fft.rfftfreq(n, 0.5)[1:]) and np.allclose(g.power, p[1:]) and set(g.n_segments) == {len(z)}


def test_fall_of_a_steep_and_a_flat_spectrum(spark):
    rng = np.random.default_rng(9)
    flat = rng.normal(size=20000)
    d = record(spark, np.cumsum(flat), flat)
    s = maps.run_spectra(d, ["site"], "i", ["x", "y"], nperseg=4096)
    r = {v.chan: v for v in maps.decades_of_fall(s, ["site", "chan"]).collect()}
    assert r["x"].to_hz == 0.4 and r["x"].decades_of_fall > 4 and abs(r["y"].decades_of_fall) < 0.4 and r["y"].band_power == pytest.approx(2.0, rel=0.4)
    few = record(spark, flat[:15], flat[:15])
    assert maps.run_spectra(few, ["site"], "i", ["x"]).count() == 0
