"""Source divergence audit: how the sources of one language differ in the use of its common terms, priced on hash-consed segment trees.

A group is the documents of one (lang, source). A language keeps the terms of at least `min_docs` of its documents. A group's counts of the kept
terms are smoothed to whole-number shares p = 1 + floor(scale (count + smooth) / (N + smooth V)), and two groups differ by the sum of |p - q|.

The counts of a group are a segment tree over the numbers of the kept terms. Trees are hash-consed: a node is known by its two children, a leaf by
its count, so equal runs of counts (above all the empty ones) are one node in all trees. Two trees are walked from their roots together; a pair of
nodes that comes up again on a level is one entry of that level's memo, so it is priced once, and its price is read wherever it came up.

The upper levels of the trees are Spark's: terms are dealt into segments of about `leaves` kept terms, each segment of a language is one subtree
per group, and the prices of segments are added up by a groupBy. A task holds one segment of two blocks of at most `block` groups, so its memory
is bounded however many terms, groups or documents there are. Terms are counted per batch before anything is shuffled.

Arithmetic is exact: 64-bit while scale (count + smooth) fits, Python's whole numbers beyond that, decimals in SQL.

Defined results: null text, lang or source is the empty text; a group without kept terms has all counts 0; a language that keeps no term has
value 0 for every pair and no term rows; repeated rows count each; equal values are ranked by the UTF-8 bytes of the item; an empty table gives
no rows; very long texts are counted whole; further columns are not read, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arraytide.llm import common, vocab

ABSENT = -1  # the leaf that pads a tree; it costs nothing


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", slice_bytes: int = 4 << 20) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
            code_of = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
            group = code_of[0] * len(names[1].dictionary) + code_of[1]
            data, offsets = common.byte_column(batch.column("text"))
            for a, b in common.row_slices(offsets, slice_bytes):
                code, words, row = vocab.coded(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], vocab.NOT_TERM)
                size = max(len(words), 1)
                once = np.unique(row * size + code)  # a term of a document
                found, n = np.unique(group[a:b][row] * size + code, return_counts=True)
                _, df = np.unique(group[a:b][once // size] * size + once % size, return_counts=True)
                of_lang, of_source = np.divmod(found // size, max(len(names[1].dictionary), 1))
                yield pa.RecordBatch.from_arrays(
                    [names[0].dictionary.take(pa.array(of_lang)), names[1].dictionary.take(pa.array(of_source)),
                     words.take(pa.array(found % size)).cast(pa.large_string()).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(df.astype(np.int64))],
                    ["lang", "source", "term", "n", "df"])

    t = docs.select(*(common.text_of(c).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    found = t.mapInArrow(task, "lang string, source string, term string, n long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column, total: Column, terms: Column, scale: int, smooth: int) -> Column:
    """The whole-number share, by decimals."""
    top = F.lit(scale).cast("decimal(12,0)") * (count + smooth).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, (total + F.lit(smooth) * terms).cast("decimal(20,0)"))


def forest(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(count of every leaf node, (left, right) of every inner node level by level from below, root of every row).

    Rows are trees; nodes of one level with equal children are one node, whichever rows they come from.
    """
    width = 1 << max(counts.shape[1] - 1, 0).bit_length()
    padded = np.full((len(counts), width), ABSENT, np.int64)
    padded[:, : counts.shape[1]] = counts
    leaves, node = np.unique(padded, return_inverse=True)
    node, levels = node.reshape(padded.shape), []
    while node.shape[1] > 1:
        size = int(node.max()) + 1
        pairs, inverse = np.unique(node[:, ::2] * size + node[:, 1::2], return_inverse=True)
        node = inverse.reshape(len(node), -1)
        levels.append(np.divmod(pairs, size))
    return leaves, levels, node[:, 0]


def shares(counts: np.ndarray, total: np.ndarray, terms: int, scale: int, smooth: int) -> np.ndarray:
    exact = scale * (int(counts.max(initial=0)) + smooth) < 1 << 63
    c, n = (counts, total) if exact else (counts.astype(object), total.astype(object))
    return 1 + scale * (c + smooth) // (n + smooth * terms)


def prices(levels: list[tuple[np.ndarray, np.ndarray]], leaves: np.ndarray, one: int, others: np.ndarray, total: int, totals: np.ndarray, terms: int,
           scale: int, smooth: int) -> np.ndarray:
    """The difference of the tree with root `one` from each of the trees `others`; totals are their N. Every node pair is priced once."""
    walk, x, y, memo = np.arange(len(others)), np.full(len(others), one), others, []
    for left, right in reversed(levels):
        a, b = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
        size = int(max(a.max(), b.max())) + 1
        key, back = np.unique((np.concatenate([walk, walk]) * size + a) * size + b, return_inverse=True)
        memo.append(back)
        walk, x, y = key // (size * size), key // size % size, key % size
    p, q = leaves[x], leaves[y]
    price = np.abs(shares(p, np.full(len(x), total), terms, scale, smooth) - shares(q, totals[walk], terms, scale, smooth))
    price = np.where(p == ABSENT, 0, price).astype(np.int64)
    for back in reversed(memo):
        half = len(back) // 2
        price = price[back[:half]] + price[back[half:]]
    return price


def pair_prices(own: DataFrame, groups: DataFrame, segments: DataFrame, scale: int, smooth: int, block: int) -> DataFrame:
    """lang, x, y (group numbers, x < y), value: over all kept terms.

    own: lang, segment, term, number, n; groups: lang, number, total, terms; segments: lang, segment, size (its kept terms).
    """
    def price(key: tuple, t: pa.Table, task: pa.Table) -> pa.Table:
        lang, _, one, other = (k.as_py() for k in key)
        size, terms, members = task.column("size")[0].as_py(), task.column("terms")[0].as_py(), task.column("members").to_pylist()
        number = np.array(sorted({m["number"]: m["total"] for held in members for m in held}.items()), np.int64)
        counts = np.zeros((len(number), size), np.int64)
        words = t.column("term").combine_chunks().dictionary_encode()
        words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        at, n = words.indices.to_numpy(), t.column("n").to_numpy()
        # terms that are frequent in all groups come first, so that the rare ones leave whole subtrees empty
        order = np.empty(len(words.dictionary), np.int64)
        order[np.argsort(-np.bincount(at, n, len(words.dictionary)), kind="stable")] = np.arange(len(words.dictionary))
        counts[np.searchsorted(number[:, 0], t.column("number").to_numpy()), order[at]] = n
        leaves, levels, root = forest(counts)
        out = []
        for i in range(len(number)):
            # within one block every pair once, else only pairs of the two blocks
            js = np.arange(i + 1, len(number)) if one == other else np.flatnonzero(number[:, 0] // block == other) if number[i, 0] // block == one else np.empty(0, np.int64)
            if len(js):
                out.append((np.full(len(js), number[i, 0]), number[js, 0], prices(levels, leaves, root[i], root[js], int(number[i, 1]), number[js, 1], terms, scale, smooth)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pa.table({"lang": pa.array([lang] * len(cols[0]), pa.string()), **{k: pa.array(c) for k, c in zip("xy", cols[:2], strict=True)}, "value": pa.array(cols[2])})

    blocks = groups.withColumn("b", (F.col("number") / block).cast("long")).groupBy("lang", "b").agg(
        F.max("terms").alias("terms"), F.collect_list(F.struct("number", "total")).alias("members"))
    blocks = blocks.withColumn("last", F.max("b").over(Window.partitionBy("lang")))
    # a pair of blocks is named from both sides; a block on its own once
    sides = blocks.select("lang", "b", "terms", "members", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("c"))
    sides = sides.select("lang", F.least("b", "c").alias("one"), F.greatest("b", "c").alias("other"), "terms", "members")
    tasks = segments.join(sides, "lang")
    width = blocks.groupBy("lang").agg(F.max("last").alias("last"))
    rows = own.join(width, "lang").select("*", (F.col("number") / block).cast("long").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("c"))
    rows = rows.select("lang", "segment", F.least("b", "c").alias("one"), F.greatest("b", "c").alias("other"), "term", "number", "n")
    key = ("lang", "segment", "one", "other")
    found = rows.groupBy(*key).cogroup(tasks.groupBy(*key)).applyInArrow(price, "lang string, x long, y long, value long")
    return found.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, scale: int = 1_000_000_000, smooth: int = 5, leaves: int = 512, block: int = 64,
          text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: every other source by difference (part `pair`), the `top` terms a source overuses (part `term`)."""
    counts = common.stored(term_counts(docs, text, lang, source), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= min_docs).drop("df")
    kept = common.stored(kept, "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    segment = F.pmod(F.xxhash64("term"), F.floor(F.col("terms") / leaves) + 1)
    own = common.stored(counts.select("lang", "source", "term", "n").join(kept.join(sizes, "lang").withColumn("segment", segment), ["lang", "term"]), "kept-counts")
    named = docs.select(common.text_of(lang).alias("lang"), common.text_of(source).alias("source")).distinct()
    groups = named.join(own.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(sizes.select("lang", "terms"), "lang", "left")
    groups = groups.fillna(0, ["total", "terms"]).withColumn("number", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
    groups = common.stored(groups, "groups")

    mine = share(F.col("n"), F.col("total"), F.col("terms"), scale, smooth)
    whole = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), scale, smooth)
    over = own.join(groups.select("lang", "source", "total"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (mine - whole).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = over.where("value > 0").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    numbered = own.join(groups.select("lang", "source", "number"), ["lang", "source"]).select("lang", "segment", "term", "number", "n")
    per = kept.join(sizes, "lang").select("lang", segment.alias("segment")).groupBy("lang", "segment").agg(F.count(F.lit(1)).alias("size"))
    priced = pair_prices(numbered, groups.select("lang", "number", "total", "terms"), per, scale, smooth, block)
    both = priced.select("lang", F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("p"), "value").select("lang", "p.x", "p.y", "value")
    name = groups.select("lang", F.col("number").alias("x"), "source")
    other = groups.select("lang", F.col("number").alias("y"), F.col("source").alias("item"))
    pairs = both.join(name, ["lang", "x"]).join(other, ["lang", "y"]).select("lang", "source", "item", "value")
    # languages that keep no term: the pairs of their sources, which are the result's own rows
    bare = groups.where("terms = 0")
    bare = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.unionByName(bare.withColumn("value", F.lit(0).cast("long")))
    pairs = pairs.withColumn("rank", F.row_number().over(by)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
