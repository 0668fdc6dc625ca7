"""What the corpus operators share: tables in the shared folder, and texts as byte arrays inside Arrow tasks."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# tasks give memory back when they free it: an executor holds several workers beside its heap
pa.set_memory_pool(pa.system_memory_pool())


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Only a local session that names none gets a fresh one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """`df` computed once, written to the shared folder and read back: a lineage cut that survives lost executors.

    While it is written, Python tasks get batches of about `batch_bytes`, since a batch is held by the executor and by the worker at once.
    """
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(batch_bytes))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`df`, stored, and its number of rows, counted while they are written."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def text_of(col: str | Column = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def parts_for(df: DataFrame, text: str = "text", part_bytes: int = 8 << 20) -> int:
    """How many parts of about `part_bytes` UTF-8 bytes of text a table makes: follows the data, has no ceiling."""
    total = df.agg(F.sum(F.octet_length(text_of(text)) + F.lit(16)).alias("n")).first()["n"] or 0
    return int(total // part_bytes) + 1


def byte_column(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values back to back, n + 1 offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and offsets[-1] else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each, so that work arrays stay small; one long row makes its own range."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


def planes(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of 64-bit values, byte place by byte place: high bytes that hardly vary then compress away."""
    return np.ascontiguousarray(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(blob: bytes | memoryview, width: int) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8").astype(np.uint64, copy=False)
