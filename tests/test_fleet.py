"""The coherence queries take every nation and every region as a station, on every day."""
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from arraytide.queries import load_all

DAYS = 1100


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three nations of two regions; the first two ship every day, the third on every second day."""
    root = str(tmp_path_factory.mktemp("fleet"))
    rng = np.random.default_rng(5)
    rows = [(s, d, n) for s in (1, 2, 3) for d in range(0, DAYS, 2 if s == 3 else 1) for n in (1, 2)]
    quantity = rng.integers(1, 50, len(rows)).astype(float)
    put = lambda name, **cols: pq.write_table(pa.table(cols), os.path.join(root, f"{name}.parquet"))
    put("lineitem", l_suppkey=pa.array([r[0] for r in rows], pa.int64()), l_shipdate=pa.array(pd.Timestamp("1995-01-01") + pd.to_timedelta([r[1] for r in rows], unit="D"), pa.timestamp("us")),
        l_quantity=quantity, l_linenumber=pa.array(rng.integers(1, 8, len(rows)), pa.int32()), l_discount=quantity / 1000, l_tax=quantity / 1000)
    put("supplier", s_suppkey=pa.array([1, 2, 3], pa.int64()), s_nationkey=pa.array([0, 1, 2], pa.int32()))
    put("nation", n_nationkey=pa.array([0, 1, 2], pa.int32()), n_regionkey=pa.array([0, 0, 1], pa.int32()))
    put("region", r_regionkey=pa.array([0, 1], pa.int32()))
    return root


def test_every_pair_of_stations_has_a_row_and_whole_records_a_coherence(spark, folder):
    got = {(r.a, r.b): r for r in load_all()[0]["pair_coherence"](spark, folder).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 2), (100, 101)}
    first = (pd.Timestamp("1995-01-01") - pd.Timestamp("1970-01-01")).days
    segs = pd.Series([s // 8 for s in range(-(-first // 16), (first + DAYS) // 16)]).value_counts()
    assert got[0, 1].chunks == (segs >= 4).sum() and got[0, 1].coh is not None
    assert all(got[p].coh is None and got[p].chunks == 0 for p in ((0, 2), (1, 2), (100, 101)))


def test_every_stretch_of_every_station_has_a_row(spark, folder):
    got = load_all()[0]["octave_coherence"](spark, folder).toPandas()
    assert set(got["site"]) == {0, 1, 2, 100, 101}
    assert got.groupby("site")["stretch"].nunique().min() >= DAYS // 256
    assert got[got["site"] == 2]["coh"].isna().all() and got[got["site"].isin([0, 1, 100])]["coh"].notna().all()
