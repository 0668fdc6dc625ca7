"""Responses with error bars from overlapped segments of kept stretches, against plain numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from arraytide.operators import estimate, spectral

CH = ["hx", "hy", "ex", "ey", "rx", "ry"]
Z = {"ex": (0.3, 5.0), "ey": (-4.0, 0.2)}


def record(spark, n, noise, seed=21):
    rng = np.random.default_rng(seed)
    hx, hy = rng.normal(size=(2, n))
    v = {"hx": hx, "hy": hy, **{k: a * hx + b * hy + noise * rng.normal(size=n) for k, (a, b) in Z.items()},
         "rx": hx + 0.5 * rng.normal(size=n), "ry": hy + 0.5 * rng.normal(size=n)}
    rows = [("s", i, *[float(v[c][i]) for c in CH]) for i in range(n)]
    return spark.createDataFrame(rows, "site string, i long, " + ", ".join(f"{c} double" for c in CH)), v


def test_segments_restart_in_every_kept_stretch(spark):
    df, v = record(spark, 700, 1.0)
    # stretches: 0-99, 101-299 (a row is gone), 300-339 too short, 341-699 with one channel blank at 340
    df = df.where("i <> 100 and i <> 300").withColumn("ry", F.when(F.col("i") != 340, F.col("ry")))
    want = [*range(0, 100 - 31, 8), *range(101, 300 - 31, 8), *range(341, 700 - 31, 8)]
    for block in (50, 128, 10_000):
        got = {r.seg: r for r in spectral.run_segments(df, ["site"], "i", CH, 32, 8, 60, block).collect()}
        assert sorted(got) == want
        assert all(np.array_equal(got[s].ex, v["ex"][s:s + 32]) for s in want)
    assert spectral.run_segments(df.limit(0), ["site"], "i", CH, 32, 8, 60).count() == 0


def test_errors_are_the_residual_power_through_the_reference(spark):
    df, v = record(spark, 1200, 2.0)
    fc = spectral.segment_fft(spectral.run_segments(df, ["site"], "i", CH, 64, 16), ["site"], CH, 1, 32, "kaiser")
    bands = spark.createDataFrame([(1, 4, 9), (2, 8, 20), (3, 40, 50)], "band int, i_min int, i_max int")
    got = {(r.band, r.comp): r for r in estimate.remote_reference(fc, ["site"], bands=bands, iterations=0, errors=True).collect()}
    assert {b for b, _ in got} == {1, 2}
    w = np.kaiser(64, 20.0)
    spec = {c: np.array([np.fft.rfft((x[k:k + 64] - x[k:k + 64].mean()) * w) for k in range(0, 1200 - 63, 16)]) for c, x in v.items()}
    for band, lo, hi in ((1, 4, 9), (2, 8, 20)):
        h, r = (np.stack([spec[c][:, lo:hi + 1].ravel() for c in p]) for p in (("hx", "hy"), ("rx", "ry")))
        a = np.linalg.inv(h @ r.conj().T)
        for x in ("ex", "ey"):
            e = spec[x][:, lo:hi + 1].ravel()
            z = e @ r.conj().T @ a
            var = (np.abs(e - z @ h) ** 2).sum() / (len(e) - 2) * np.diag(a.T @ (r @ r.conj().T).conj() @ a.conj()).real
            for k, c in enumerate(("hx", "hy")):
                g = got[band, f"{x}_{c}"]
                assert g.n == len(e) and complex(g.re, g.im) == pytest.approx(z[k], rel=1e-8) and g.err == pytest.approx(np.sqrt(var[k]), rel=1e-8)


def test_errors_cover_what_repeated_records_scatter(spark):
    """Apart segments, so the error is not shared; the scatter of 40 stations about the truth is what the bars say."""
    n, m, rng = 64 * 30, 40, np.random.default_rng(22)
    rows = []
    for s in range(m):
        hx, hy = rng.normal(size=(2, n))
        e = [a * hx + b * hy + rng.normal(size=n) for a, b in Z.values()]
        rx, ry = hx + 0.5 * rng.normal(size=n), hy + 0.5 * rng.normal(size=n)
        for k in range(0, n, 64):
            rows.append((s, k // 64, *[[float(q) for q in c[k:k + 64]] for c in (hx, hy, *e, rx, ry)]))
    arr = spark.createDataFrame(rows, "site long, seg long, " + ", ".join(f"{c} array<double>" for c in CH))
    fc = spectral.segment_fft(arr, ["site"], CH, 4, 24)
    g = estimate.remote_reference(fc, ["site"], band=F.lit(0), iterations=0, errors=True).toPandas()
    truth = {f"{x}_{h}": v for x, zs in Z.items() for h, v in zip(("hx", "hy"), zs, strict=True)}
    t = ((g.re - g.comp.map(truth)) ** 2 + g.im ** 2) / g.err ** 2
    # neighbouring harmonics of a Hann window share power, so bars of white harmonics are too small by up to the root of 1.9
    assert 0.8 < t.mean() < 2.4


def test_two_samples_have_no_error_and_robust_errors_shrink(spark):
    df, v = record(spark, 64 * 40, 1.0)
    wild = df.withColumn("ex", F.when(F.floor(F.col("i") / 64) == 7, F.col("ex") * 300).otherwise(F.col("ex")))
    fc = spectral.segment_fft(spectral.run_segments(wild, ["site"], "i", CH, 64, 64), ["site"], CH, 4, 24)
    plain, robust = ({r.comp: r for r in estimate.remote_reference(fc, ["site"], band=F.lit(0), iterations=n, errors=True).collect()} for n in (0, 3))
    assert robust["ex_hy"].err < plain["ex_hy"].err / 3 and robust["ex_hy"].re == pytest.approx(5.0, abs=4 * robust["ex_hy"].err)
    two = estimate.remote_reference(fc.where("seg < 128"), ["site"], iterations=0, errors=True).collect()
    assert two and all(r.n == 2 and r.err is None for r in two)
