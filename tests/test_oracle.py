"""Every registered query against its own DuckDB statement on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare  # noqa: E402

from arraytide.queries import load_all  # noqa: E402
from arraytide.queries.registry import COVERS, TABLES  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert len(set(got.columns)) == len(got.columns)
    if name in ORACLES:
        assert compare(got, duck.execute(ORACLES[name]).df()) == ""


def test_every_query_names_what_it_stands_for():
    assert all(COVERS[n] for n in QUERIES)
    assert set(ORACLES) <= set(QUERIES)
