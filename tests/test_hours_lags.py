"""Hour scores, daily lines, member lags and the clock test at the sizes of real records, against plain numpy."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arraytide.functions import kernels
from arraytide.operators import decisions, hours, lags

CH = ["hx", "hy", "hz", "ex", "ey"]


def samples(spark, records, t0=0, blank=()):
    """(site, i, channels): `records` maps a station to an array of five channels; blanked (station, channel or None, from, to) are NULL."""
    frames = []
    for s, x in records.items():
        x = x.copy()
        for who, c, a, b in blank:
            if who == s:
                x[slice(None) if c is None else CH.index(c), a:b] = np.nan
        d = pd.DataFrame(x.T, columns=CH).assign(site=s, i=np.arange(x.shape[1]) + t0)
        frames.append(d[["site", "i", *CH]])
    t = spark.createDataFrame(pd.concat(frames), "site string, i long, " + ", ".join(f"{c} double" for c in CH))
    return t.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in CH})


def field(rng, n):
    """A smooth field: noise through a one-pole filter."""
    x, y = rng.normal(size=n), np.zeros(n)
    for k in range(1, n):
        y[k] = 0.9 * y[k - 1] + x[k]
    return y


def band_coherence(x, y, nperseg, lo, hi):
    step, w = nperseg // 2, 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    a, b = (np.array([np.fft.rfft((v[k:k + nperseg] - v[k:k + nperseg].mean()) * w) for k in range(0, len(v) - nperseg + 1, step)]) for v in (x, y))
    c = np.abs((a * b.conj()).sum(0)) ** 2 / ((np.abs(a) ** 2).sum(0) * (np.abs(b) ** 2).sum(0))
    f = np.fft.rfftfreq(nperseg)
    return np.median(c[(f > 1 / hi) & (f < 1 / lo)])


def test_hour_scores_at_the_sizes_of_a_record(spark):
    rng = np.random.default_rng(1)
    n, t0 = 4 * 3600 + 900, 1800  # starts half an hour into hour 0
    h = np.stack([field(rng, n) for _ in range(3)])
    x = np.stack([*h, h[1] + 0.5 * rng.normal(size=n), h[0] + 20 * rng.normal(size=n)])
    t = samples(spark, {"a": x, "b": x[::-1]}, t0, blank=[("a", "ex", 3000, 3001), ("a", "hx", 9500, 9600), ("a", "ey", 9500, 9600)])
    got = {r["hour"]: r for r in hours.hour_scores(t.where("site = 'a'"), ["site"], "i").collect()}
    assert set(got) == {1, 2, 3}  # whole hours only
    for k in got:
        part = x[:, k * 3600 - t0:(k + 1) * 3600 - t0]
        xy, yx = band_coherence(part[3], part[1], 1024, 20, 200), band_coherence(part[4], part[0], 1024, 20, 200)
        gap = {1: (True, False), 3: (False, True)}.get(k, (False, False))
        if k == 1:
            assert got[k]["coh_xy"] is None  # one missing sample refuses the pair and leaves the other
        else:
            assert got[k]["coh_xy"] == pytest.approx(xy, abs=1e-6)
        if gap[1]:
            assert got[k]["coh_yx"] is None
        else:
            assert got[k]["coh_yx"] == pytest.approx(yx, abs=1e-6)
        there = [v for v in (got[k]["coh_xy"], got[k]["coh_yx"]) if v is not None]
        assert got[k]["score"] == pytest.approx(np.mean(there), abs=2e-6)
    assert got[2]["coh_xy"] > 0.9 > 0.5 > got[2]["coh_yx"]


def test_daily_lines_at_the_sizes_of_a_record(spark):
    rng = np.random.default_rng(2)
    day, n = 86_400, 2 * 86_400 + 4 * 3600  # the third day is too short
    h = np.stack([field(rng, n) for _ in range(3)])
    x = np.stack([*h, h[1] + 0.2 * rng.normal(size=n), 0.2 * rng.normal(size=n)])
    x[4, day:2 * day] *= 0.01
    t = samples(spark, {"a": x}, 0, blank=[("a", "ex", 500, 2500)])
    lines = hours.daily_lines(t, ["site"], "i")
    got = {r["day"]: r for r in lines.collect()}
    assert set(got) == {0, 1}
    coef = kernels.butter(2, [1 / 3000.0], 1.0, "high")
    for k in got:
        part = {c: x[i, k * day:(k + 1) * day].copy() for i, c in enumerate(CH)}
        if k == 0:
            part["ex"][500:2500] = np.nan
        y = {c: kernels.bridged(kernels.despiked(v)) for c, v in part.items()}
        y = {c: kernels.filtfilt(*coef, v - v.mean()) for c, v in y.items()}
        assert got[k]["coh_ex_hy"] == pytest.approx(band_coherence(y["ex"], y["hy"], 4096, 20, 200), abs=6e-4)
        assert got[k]["coh_ex_ey"] == pytest.approx(band_coherence(y["ex"], y["ey"], 4096, 20, 200), abs=6e-4)
        assert got[k]["std_ey"] == pytest.approx(y["ey"].std(), abs=6e-4)
    states = {r["day"]: (r["ex_state"], r["ey_state"]) for r in decisions.line_states(lines, ["site"], {"ex": "coh_ex_hy", "ey": "coh_ey_hx"}).collect()}
    assert states == {0: ("sound", "weak"), 1: ("sound", "dead")}
    gap = samples(spark, {"a": x}, 0, blank=[("a", "hy", 0, 20_000)])
    assert {r["day"]: r["std_ex"] is None for r in hours.daily_lines(gap, ["site"], "i").collect()} == {0: True, 1: False}


def test_filter_by_blocks_equals_the_stepped_one():
    rng = np.random.default_rng(3)
    for coef in (kernels.butter(2, [1 / 3000.0], 1.0, "high"), kernels.butter(4, [1 / 20, 1 / 5], 1.0, "band"), kernels.butter(4, [1 / 200, 1 / 20], 1.0, "band")):
        order = len(coef[1]) - 1
        for n in (100, 512, 2000):
            x, z = rng.normal(size=(3, n)), np.zeros((order, 3))
            assert np.allclose(kernels.recursive(*coef, x, z), kernels._stepped(*coef, x, z)[0], atol=1e-8)


def delayed(x, k):
    return np.roll(x, k, axis=1)


def test_member_lags_and_every_refusal(spark):
    rng = np.random.default_rng(4)
    n = 16_000
    base = np.stack([field(rng, n) for _ in range(5)])
    noise = lambda s: s * rng.normal(size=(5, n))
    drift = np.concatenate([delayed(base, 1)[:, : n // 2], delayed(base, 9)[:, n // 2:]], axis=1)
    # both follow one fast field and a slow one of their own
    slow = lambda: 40 * np.stack([np.convolve(rng.normal(size=n), np.ones(40) / 40, "same") for _ in range(5)])
    records = {"t": base, "late": delayed(base, 4) + noise(0.05), "drift": drift, "other": np.stack([field(rng, n) for _ in range(5)]), "gappy": delayed(base, -3),
               "apart": np.diff(base, axis=1, append=0) + slow()}
    # only 2,500 samples at a time: too short for the first form, long enough for the second
    blank = [("gappy", None, a, a + 500) for a in range(0, n, 3000)]
    t = samples(spark, records, 0, blank)
    pairs = spark.createDataFrame([("t", x) for x in ("late", "drift", "other", "gappy", "missing", "apart")], "a string, b string")
    got = {r["b"]: r for r in lags.member_lags(t, pairs, "site", "i", win=4000, fallback=2000, block=5000).collect()}
    assert set(got) == {"late", "drift", "other", "gappy", "missing", "apart"}
    assert got["late"]["note"] == "" and got["late"]["lag_s"] == pytest.approx(4, abs=0.1) and got["late"]["win"] == 4000 and got["late"]["n_windows"] == 4
    assert got["gappy"]["note"] == "" and got["gappy"]["lag_s"] == pytest.approx(-3, abs=0.1) and got["gappy"]["win"] == 2000 and got["gappy"]["n_windows"] >= 2
    assert got["drift"]["note"] == "the lag is not one constant" and got["drift"]["lag_s"] == 0 and got["drift"]["spread"] > 1
    assert got["other"]["lag_s"] == 0 and got["other"]["note"] == "no usable window"
    assert got["apart"]["lag_s"] == 0 and got["apart"]["note"] in ("the long band does not correlate", "no usable window")
    assert got["missing"]["note"] == "no usable window" and got["missing"]["n_windows"] == 0


def test_clock_test_gates_each_day(spark):
    rng = np.random.default_rng(5)
    day, days = 4000, 10
    n = day * days
    base = np.stack([field(rng, n) for _ in range(5)])
    base[2] += 1000
    model = spark.createDataFrame([("s", 1000.0), ("f", 2000.0), ("w", 1000.0), ("e", 1000.0)], "site string, model_f double")
    records = {"s": delayed(base, -25), "f": delayed(base, -25), "r": base, "w": np.stack([field(rng, n) for _ in range(5)]) + np.array([0, 0, 1000, 0, 0])[:, None],
               "e": delayed(base, 1990)}
    t = samples(spark, records, 0, blank=[("s", "hx", 2 * day, 2 * day + 1500), ("r", "hx", 5 * day, 5 * day + 3000)])
    pairs = spark.createDataFrame([(x, "r") for x in "sfwe"], "site string, ref string")
    how = {"day": day, "halo": 2000, "band": (1 / 20.0, 1 / 5.0)}
    got = {(r["site"], r["day"]): r for r in lags.clock_days(t, pairs, "site", "i", **how).collect()}
    # the first and the last day lack a halo, day 2 of s is mostly missing, and so is what days 4 and 5 meet in r
    assert {d for s, d in got if s == "s"} == {1, 3, 6, 7, 8}
    x = records["s"][0, 3 * day:4 * day]
    assert got["s", 3]["lag_s"] == pytest.approx(25, abs=0.2) and got["s", 3]["r"] > 0.9 and got["s", 3]["ratio"] > 5 and not got["s", 3]["edge"] and len(x) == day
    assert got["e", 3]["edge"] and got["e", 3]["r"] > 0.4
    v = {r["site"]: r for r in lags.clock_test(t, pairs, model, "site", "i", least=3000, **how).collect()}
    assert v["s"]["judged"] and v["s"]["median_lag_s"] == pytest.approx(25, abs=0.2) and not v["s"]["ok"] and v["s"]["n_days"] == 5
    assert v["f"]["n_days"] == 0 and not v["f"]["judged"]  # half of its model's field
    assert v["w"]["n_days"] == 0 and v["e"]["n_days"] == 0  # no peak; a peak at the edge of the search
    near = {r["site"]: r for r in lags.clock_test(t, pairs, model, "site", "i", least=3000, limit=30, **how).collect()}
    assert near["s"]["ok"]


def test_member_lags_measure_every_window(spark):
    rng = np.random.default_rng(8)
    win, n = 1000, 20
    base = np.stack([field(rng, win * n) for _ in range(5)])
    # a clock that is off in two windows in the middle, between those that eight spread ones would be
    off = delayed(base, 2)
    off[:, 9 * win:11 * win] = delayed(base, 9)[:, 9 * win:11 * win]
    t = samples(spark, {"t": base, "late": delayed(base, 2), "off": off}, blank=[("late", None, 3 * win, 3 * win + 1)])
    pairs = spark.createDataFrame([("t", "late"), ("t", "off")], "a string, b string")
    got = {r["b"]: r for r in lags.member_lags(t, pairs, "site", "i", win=win, fallback=500, block=3000).collect()}
    # the missing sample costs one window
    assert got["late"]["note"] == "" and got["late"]["lag_s"] == pytest.approx(2, abs=0.1) and got["late"]["n_windows"] == n - 1
    assert got["off"]["n_windows"] == n and got["off"]["spread"] == pytest.approx(7, abs=0.3)
    assert got["off"]["note"] == "the lag is not one constant" and got["off"]["lag_s"] == 0


def test_member_lags_compute_their_record_once(spark):
    rows = [(s, i, float(np.sin(i * 1.3 + s) + np.sin(i / 2.5)), float(np.cos(i * 1.7))) for s in (1, 2) for i in range(400)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    schema = "site long, i long, hx double, hy double"
    t = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    got = lags.member_lags(t, spark.createDataFrame([(1, 2)], "a long, b long"), "site", "i", win=96, fallback=64, max_lag=5, short=(1 / 8.0, 1 / 3.0), long=(1 / 24.0, 1 / 8.0)).collect()
    assert len(got) == 1 and read.value == len(rows)
