"""Embedding near-duplicates by lattice hashing: random projections decoded to E8 lattice points, several tables, neighbouring cells probed.

Vectors of one label are linked when their cosine (double precision) is at least `least`. Equal vectors are collapsed first, so a group of
copies is one point with a weight. A point is stored under its own cell in each table; a table's cell is `codes` E8 points of independent
8-dimensional projections of the unit vector. Every point also looks into the cells nearest to its projections, so near points that fall on
two sides of a cell wall still meet. Candidates are verified by cosine: no false link, and the tests measure the recall.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without label, link with nothing and are
their own component; vectors of different length do not link; repeated rows are equal vectors and link; a row without vec_id can link, and its
component is named by the ids that are there; an empty table gives no rows.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common
from arraytide.llm.components import components
from arraytide.llm.hashing import mix


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum: where rounding gives an odd one, the worst coordinate goes the other way."""
    near = np.rint(x)
    off = x - near
    row = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[row]).argmax(1)
    near[row, worst] += np.where(off[row, worst] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: E8 is D8 and D8 moved by one half in every coordinate."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


@cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    two = [s for i, j in itertools.combinations(range(8), 2) for a, b in itertools.product((1, -1), repeat=2)
           for s in [[a if k == i else b if k == j else 0 for k in range(8)]]]
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*two, *half], float)


@cache
def _projections(dim: int, tables: int, codes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((tables, codes, dim, 8)) * scale, rng.uniform(-4, 4, (tables, codes, 8))


def cells(unit: np.ndarray, tables: int, codes: int, probes: int, scale: float, seed: int = 8) -> np.ndarray:
    """(rows, tables, ways) 64-bit cell numbers of unit vectors; way 0 is the own cell, the others combine the `probes` nearest of each code."""
    ways = list(itertools.product(range(probes + 1), repeat=codes))
    out = np.zeros((len(unit), tables, len(ways)), np.uint64)
    project, move = _projections(unit.shape[1], tables, codes, scale, seed)
    for t in range(tables):
        kinds = []
        for c in range(codes):
            y = unit @ project[t, c] + move[t, c]
            own = nearest(y)
            far = -2 * (y - own) @ neighbours().T  # squared distances less what is the same for all 240
            close = np.argpartition(far, probes, axis=1)[:, :probes] if probes else np.zeros((len(y), 0), int)
            close = np.take_along_axis(close, np.take_along_axis(far, close, 1).argsort(1), 1)
            around = np.concatenate([own[:, None], own[:, None] + neighbours()[close]], 1)
            code = np.zeros(around.shape[:2], np.uint64)
            for k in range(8):
                code = mix(code ^ (2 * around[..., k]).astype(np.int64).view(np.uint64))
            kinds.append(code)
        for w, way in enumerate(ways):
            h = np.full(len(unit), t + 1, np.uint64)
            for c, k in enumerate(way):
                h = mix(h ^ kinds[c][:, k])
            out[:, t, w] = h
    return out


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    flat, at = np.asarray(column.values), np.asarray(column.offsets)
    return flat[at[rows][:, None] + np.arange(dim)].astype(np.float64)


def _keys(reps: DataFrame, tables: int, codes: int, probes: int, scale: float) -> DataFrame:
    """key, node, own: every cell that a point lies in (own) or looks into."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                node, label = np.asarray(batch.column("node")), np.asarray(batch.column("label")).astype(np.int64)
                size = np.diff(np.asarray(batch.column("embedding").offsets))
                for dim in np.unique(size).tolist():
                    rows = np.flatnonzero(size == dim)
                    m = _matrix(batch.column("embedding"), rows, dim)
                    keys = cells(m / np.linalg.norm(m, axis=1, keepdims=True), tables, codes, probes, scale)
                    keys = mix(keys ^ mix(label[rows].view(np.uint64) * np.uint64(31) + np.uint64(dim))[:, None, None])
                    own = np.zeros(keys.shape, bool)
                    own[..., 0] = True
                    yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(node[rows], keys[0].size)),
                                                      pa.array(own.reshape(-1))], ["key", "node", "own"])

    return reps.select("node", "label", "embedding").mapInArrow(task, "key long, node long, own boolean")


def _verified(pairs: DataFrame, least: float) -> DataFrame:
    """u, v of the pairs (with vectors x and y of one length) whose cosine is at least `least`."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, good = np.diff(np.asarray(batch.column("x").offsets)), np.zeros(batch.num_rows, bool)
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                x, y = _matrix(batch.column("x"), rows, dim), _matrix(batch.column("y"), rows, dim)
                good[rows] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= least
            yield batch.select(["u", "v"]).filter(pa.array(good))

    return pairs.select("u", "v", "x", "y").mapInArrow(task, "u long, v long")


def links(reps: DataFrame, least: float = 0.93, tables: int = 10, codes: int = 2, probes: int = 2, scale: float = 0.5) -> DataFrame:
    """u < v: linked nodes of `reps` (node, label, embedding)."""
    keys = common.stored(_keys(reps, tables, codes, probes, scale), "cells")
    there, look = keys.where("own").select("key", F.col("node").alias("v")), keys.select("key", F.col("node").alias("u"))
    pairs = look.join(there, "key").where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    x = reps.select(F.col("node").alias("u"), F.col("embedding").alias("x"))
    y = reps.select(F.col("node").alias("v"), F.col("embedding").alias("y"))
    return _verified(pairs.join(x, "u").join(y, "v"), least)


def near_duplicates(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", **how) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).cast("long").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = v.where(usable)
    # copies are one point; its node number is fixed by the stored table
    reps = common.stored(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
                         .withColumn("node", F.monotonically_increasing_id()), "points")
    found = common.stored(links(reps, least, **how), "vector-links")
    both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = both.join(reps.select(F.col("node").alias("v"), "weight"), "v").groupBy("u").agg(F.sum("weight").alias("others"))
    roots = components(found)
    named = reps.join(roots, "node", "left").withColumn("root", F.coalesce("component_id", "node"))
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    points = (named.drop("component_id").join(names, "root").join(others, named["node"] == others["u"], "left")
              .select("label", "embedding", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    linked = good.join(points, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = v.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
