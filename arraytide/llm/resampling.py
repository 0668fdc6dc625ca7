"""Target-distribution importance resampling by bit-sliced aggregation.

Documents and target are bags of hashed features: all runs of 1 to `most` words, bucketed by CRC-32. A bucket's gain is how much likelier the
target is to use it, as a whole number of thousandths of a nat, and a document's weight is the floored mean of the gains of its features.

The sum of gains is taken by bit slices. A document's bucket counts become planes of one bit per bucket, plane i holding bit i of every count;
the gains become planes once, the last of them the sign of two's complement. The popcount of the AND of count plane i with gain plane j
says how often 2 ** (i + j) enters the sum, so a weight is exact whatever the counts are, with no product per feature.

Documents are drawn without replacement by Gumbel keys: weight plus noise that a hash of the id fixes, so every run and every engine draws the
same ones. The histogram of the whole-number scores (at most some 110,000 values at any size) gives the score at which the draw ends; only
documents at or over it are put in order, by ranges of (score, id).

Defined results: a null text is empty; a text without features has weight 0; a null doc_id is hashed as the empty text and comes before all
others; repeated rows are drawn each, in consecutive ranks; with an empty target all its shares are those of smoothing; an empty table gives no
rows; very long texts are counted whole (a document is one row of planes however long it is); further columns are not read, whatever their names.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common, vocab

ROWS = 256  # documents whose planes are held at a time


def features(data: np.ndarray, offsets: np.ndarray, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature, and the words of each row."""
    code, known, row = vocab.coded(data, offsets, vocab.NOT_WORD)
    words = known.to_pylist()
    run, crc = code, np.array([zlib.crc32(w) for w in words], np.int64)
    found, rows = [crc[run] % buckets], [row]
    for n in range(2, most + 1):
        m = max(len(code) - n + 1, 0)
        # a run is the run before it, a space and one more word: its checksum goes on from there
        pairs, run = np.unique(run[:m] * max(len(words), 1) + code[n - 1:], return_inverse=True)
        crc = np.array([zlib.crc32(b" " + words[p % len(words)], int(crc[p // len(words)])) for p in pairs.tolist()], np.int64)
        ok = row[:m] == row[n - 1:]
        found.append(crc[run[ok]] % buckets)
        rows.append(row[:m][ok])
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(offsets) - 1)


def bucket_counts(texts: DataFrame, text: str, most: int, buckets: int) -> np.ndarray:
    """How many features of the whole table fall into each bucket: one row per task and bucket is added up by Spark."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = common.byte_column(batch.column("text"))
            for a, b in common.row_slices(offsets):
                total += np.bincount(features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], most, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    per = texts.select(common.text_of(text).alias("text")).mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, object)
    for r in per.collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The whole-number gain of every bucket, in doubles."""
    n = float(len(own))
    s, t = float(sum(own)) + n, float(sum(target)) + n
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(own, target, strict=True)], np.int64)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def gain_planes(gain: np.ndarray) -> np.ndarray:
    """Two's complement, lowest bit first; the last plane is the sign."""
    width = max(int(np.abs(gain).max(initial=0)).bit_length(), 1) + 1
    return packed((gain[None] >> np.arange(width)[:, None]) & 1)


def sums(bucket: np.ndarray, row: np.ndarray, rows: int, planes: np.ndarray, buckets: int) -> np.ndarray:
    """The sum of the gains of each row's features."""
    out = np.zeros(rows, np.int64)
    key, count = np.unique(row * buckets + bucket, return_counts=True)
    of_row, of_bucket = np.divmod(key, buckets)
    worth = [1 << j for j in range(len(planes))]
    worth[-1] = -worth[-1]
    for a, b in common.row_slices(np.arange(rows + 1), ROWS):
        i, j = np.searchsorted(of_row, [a, b])
        for bit in range(int(count[i:j].max(initial=0)).bit_length()):
            on = np.flatnonzero((count[i:j] >> bit) & 1) + i
            have, at = np.unique(of_row[on], return_inverse=True)
            if not len(have):
                continue
            dense = np.zeros((len(have), buckets), np.uint8)
            dense[at, of_bucket[on]] = 1
            plane = packed(dense)
            for w, mask in zip(worth, planes, strict=True):
                out[have] += (w << bit) * np.bitwise_count(plane & mask).sum(axis=1, dtype=np.int64)
    return out


def weighted(docs: DataFrame, gain: np.ndarray, most: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    planes, buckets = gain_planes(gain), len(gain)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.byte_column(batch.column("text"))
            for a, b in common.row_slices(offsets):
                bucket, row, words = features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], most, buckets)
                n = np.bincount(row, minlength=b - a)
                mean = sums(bucket, row, b - a, planes, buckets) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *(pa.array(x.astype(np.int64)) for x in (words, n, mean))],
                                                 ["doc_id", "n_words", "n_features", "weight"])

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
    return t.mapInArrow(task, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str, doc_id: str = "doc_id"):
    """Gumbel noise in thousandths, from the first 32 bits of the id's SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: str = "2024",
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and, for the documents drawn, rank."""
    gain = gains(bucket_counts(docs, text, most, buckets), bucket_counts(target, target_text, most, buckets))
    scored = weighted(docs, gain, most, doc_id, text).withColumn("score", F.col("weight") + noise(seed))
    scored = common.stored(scored, "importance")
    histogram = scored.where(F.col("n_words") >= min_words).groupBy("score").count().collect()  # whole numbers of a fixed range
    quota, above, cut = sum(r["count"] for r in histogram) * percent // 100, 0, None
    for r in sorted(histogram, key=lambda r: -r["score"]):
        if above >= quota:
            break
        above, cut = above + r["count"], r["score"]
    columns = ("doc_id", "n_features", "weight", "score")
    near = (F.col("n_words") >= min_words) & (F.col("score") >= cut) if cut is not None else F.lit(False)
    order = (F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("tie"))
    # the tie number lets a range of equal rows be split; a place is the number of a range and the row inside it
    ordered = (scored.where(near).select(*columns, F.monotonically_increasing_id().alias("tie")).repartitionByRange(*order)
               .sortWithinPartitions(*order).drop("tie").withColumn("place", F.monotonically_increasing_id()))
    ordered = common.stored(ordered, "drawn")
    before, offsets = 0, []
    for r in sorted(ordered.groupBy(F.shiftright("place", 33).alias("range")).count().collect(), key=lambda r: r["range"]):  # one row per range
        offsets.append((r["range"], before))
        before += r["count"]
    offsets = docs.sparkSession.createDataFrame(offsets, "range long, before long")
    ranked = ordered.withColumn("range", F.shiftright("place", 33)).join(offsets, "range")
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1)
    drawn = ranked.select(*columns, F.when(F.col("rank") <= quota, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
