"""The lender chain: a stated lag across a block edge, a lender of itself, a lender without a record."""
import numpy as np
from pyspark.sql import functions as F

from arraytide.operators import decisions
from arraytide.plans import lending
from tests.test_hours_lags import field, samples

CELLS = ["e_exchange", "h_exchange", "h_gain", "e_shift_s", "sign_ex", "sign_ey", "sign_hx", "sign_hy", "sign_hz", "h_lender", "h_lender_channels", "dipole_n_m", "dipole_e_m"]


def table(spark, **stations):
    plain = dict.fromkeys(CELLS, "1") | {"e_exchange": "no", "h_exchange": "no", "e_shift_s": "0", "h_lender": "none", "h_lender_channels": "all"}
    rows = [(s, *[(plain | own)[c] for c in CELLS]) for s, own in stations.items()]
    return decisions.decision_values(spark.createDataFrame(rows, "site string, " + ", ".join(f"{c} string" for c in CELLS)), "site")


def turn(x, y, a):
    return np.cos(a) * x + np.sin(a) * y, -np.sin(a) * x + np.cos(a) * y


def test_stated_lag_is_exact(spark):
    rng, n = np.random.default_rng(8), 600
    rec = {s: np.stack([field(rng, n) for _ in range(5)]) for s in "ab"}
    t, v = samples(spark, rec), table(spark, a={"h_lender": "b"}, b={"h_lender": "b"}, c={"h_lender": "gone"})
    lag = spark.createDataFrame([("a", 3.0)], "site string, lag_s double")
    out = lending.decided(t, v, "site", "i", lag=lag, block=300)[0].orderBy("site", "i").collect()
    got = [r["hz"] for r in out if r["site"] == "a"]
    assert got[:-3] == rec["b"][2][3:].tolist() and got[-3:] == [None] * 3
    assert [r["hx"] for r in out if r["site"] == "b"] == rec["b"][0].tolist()


def test_lender_without_record_and_empty_tables(spark):
    t = samples(spark, {"c": np.ones((5, 50))})
    v = table(spark, c={"h_lender": "gone", "h_lender_channels": "hy"})
    lag = spark.createDataFrame([], "site string, lag_s double")
    rows = lending.decided(t, v, "site", "i", lag=lag, block=20)[0].collect()
    assert len(rows) == 50 and all(r["hy"] is None and r["hx"] == 1.0 for r in rows)
    assert lending.decided(t.where(F.lit(False)), v, "site", "i", lag=lag)[0].count() == 0
