"""Connected components of a table of links, by alternating large-star and small-star passes (Kiveris et al., 2014)."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common

EDGES = "u long, v long"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links as stars round the smallest node that the batch joins: fewer links, the same components."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int, root: dict[int, int] = root) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        rows = [(x, r) for x in root if (r := find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64())], ["u", "v"])


def _forest(edges: DataFrame) -> bool:
    """Whether distinct links u > v are stars already: every u has one v, and no v is a u. One aggregate instead of a pass that changes nothing."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("least") == 0))).agg(F.count(F.lit(1))).first()[0] == 0


def _named(edges: DataFrame, stars: DataFrame, column: str) -> DataFrame:
    """`edges` with the root of `column` in its place."""
    root = stars.select(F.col("node").alias(column), F.col("component_id").alias("_root")).hint("merge")
    return edges.join(root, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def components(links: DataFrame, stars: DataFrame | None = None, u: str = "u", v: str = "v") -> DataFrame:
    """node, component_id (the smallest node reachable) of every node that is not the smallest of its own component.

    `stars` is what an earlier call returned: the links then join its components, and only their smallest nodes are worked on.

    Every pass is stored, so a lost executor costs one pass. Hot nodes are aggregated before the shuffle. What grows with the links is joined by
    sort-merge, so the driver holds no relation; adaptive execution splits hot keys.
    """
    edges = links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
    if stars is not None:
        edges = _named(_named(edges, stars, "u"), stars, "v").select("u", "v")
    edges, n = common.counted(edges.where("u <> v").mapInArrow(_local, EDGES).distinct(), "links")
    while n and not _forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).hint("merge")
        # no more links than before, so what comes twice is left to the last step of the pass
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = edges.groupBy("u").agg(F.min("v").alias("m")).hint("merge")
        hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges, n = common.counted(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    fresh = edges.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    if stars is None:
        return fresh
    return common.stored(_named(stars, fresh, "component_id").select("node", "component_id").unionByName(fresh), "stars") if n else stars
