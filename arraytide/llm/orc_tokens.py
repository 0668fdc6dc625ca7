"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

`write` encodes every text, closes it with `end_id` and writes rows (part, row, doc_id, ids) in ascending doc_id order: files hold ranges of
ids, (part, row) is the place in the order. ORC keeps minimum and maximum of doc_id per stripe and per row group and a Bloom filter beside
them, so `lookup` reads only the row groups that can hold an id, and stripes are read in parallel.

Defined results: a null text is empty (one end id); null ids come first, repeated ids in the order of their text's hash; an empty table gives
an empty file set that reads back as no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arraytide.llm import common, tokens

ROWS = "part int, row long, doc_id long, ids array<int>"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, with_space: bool = False, doc_id: str = "doc_id", text: str = "text",
          stripe_bytes: int = 16 << 20, index_stride: int = 1000, part_bytes: int = 8 << 20) -> None:
    """Write the ids of `docs` to `path`. One shuffle, of the texts, deals them out in ranges of doc_id."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("doc_id")
            for a, found in tokens.encoded(batch, "text", tokenizer, with_space, end_id):
                n = len(found)
                at = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(found).view(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), ids.slice(a, n), values],
                                                 ["part", "row", "doc_id", "ids"])
                row += n

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
    order = (F.col("doc_id"), F.xxhash64("text"))
    ranged = t.repartitionByRange(common.parts_for(docs, text, part_bytes), *order).sortWithinPartitions(*order)
    (ranged.mapInArrow(task, ROWS).write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", str(index_stride)).option("compression", "zstd").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of a few documents; the filter goes down to stripe statistics and Bloom filters."""
    return read(spark, path).where(F.col("doc_id").isin(doc_ids))


def index(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what `read` gives: start counts the ids of all documents before it."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, at = np.asarray(lists.values), np.asarray(lists.offsets)
            crcs = [tokens.crc(values[i:j].view(np.uint32)) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("row"), batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)),
                                              pa.array(crcs, pa.int64())], ["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    d = common.stored(rows.mapInArrow(task, "part int, row long, doc_id long, n_tokens long, ids_crc32 long"), "token-index")
    # one row per file of megabytes, then a window inside each file
    before = d.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return d.withColumn("inside", inside).join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
