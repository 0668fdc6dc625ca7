"""Registration of queries and the shared output shape.

`cols` names every output column with its comparison type, so that the Spark result and the SQL statement end
in the same projection: b = BIGINT, d = DOUBLE rounded to 6 decimals, s = string, z = boolean.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}

# both sides add this before rounding, so a value on an exact half of the last digit cannot round two ways
TIE = 2e-10

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """The driver's parquet tables, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _parse(cols: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in cols.split()]


def shape(df: DataFrame, cols: str) -> DataFrame:
    kinds = {"b": lambda c: F.col(c).cast("bigint"), "s": lambda c: F.col(c).cast("string"),
             "z": lambda c: F.col(c).cast("boolean"),
             "d": lambda c: F.round(F.col(c).cast("double") + F.lit(TIE), 6) + F.lit(0.0)}
    return df.select(*[kinds[k](c).alias(c) for c, k in _parse(cols)])


def shape_sql(sql: str, cols: str) -> str:
    kinds = {"b": 'CAST("{c}" AS BIGINT)', "s": 'CAST("{c}" AS VARCHAR)', "z": 'CAST("{c}" AS BOOLEAN)',
             "d": 'round(CAST("{c}" AS DOUBLE) + 2e-10, 6) + 0.0'}
    sel = ", ".join(f"{kinds[k].format(c=c)} AS \"{c}\"" for c, k in _parse(cols))
    return f"SELECT {sel} FROM ({sql}) AS q"


def query(name: str, cols: str, covers: str = "", sql: str | None = None):
    """Register fn(tables) -> DataFrame under `name`; `covers` lists the inventory rows it stands for."""
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: shape(fn(Tables(spark, folder)), cols)
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = shape_sql(sql, cols)
        return fn
    return wrap
