"""Question-and-answer rounds between parts of a corpus, for jobs whose keys are too many to shuffle as rows.

A part is a few MB of whole documents, dealt out by hash. In a round every part sends its distinct 64-bit keys, packed as byte planes and split
over key buckets; a bucket sees each key of each part once, and answers the parts. Keys that a third of the corpus shares are thus aggregated
inside each part before anything is shuffled. The number of parts and of buckets follows the data, so a part and a bucket stay as small as
they are at any size.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common

PACKET = "bucket long, part long, n long, fields array<binary>"


def parted(docs: DataFrame, parts: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, doc_id, text: the exchange that all rounds of a job read again."""
    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
    return t.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("long")).repartition(parts, "part")


def packets(part: int, keys: np.ndarray, fields: list[tuple[np.ndarray, int]], buckets: int) -> pa.Table:
    """One row per bucket that some key falls into. Keys are sorted; every field is (values, bytes kept of each)."""
    if not len(keys):
        return answer([])
    # buckets are ranges of the key, so sorted keys of a bucket share their high bytes
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows.append((int(bucket[a]), part, b - a, [common.planes(keys[a:b], 8), *(common.planes(v[a:b], w) for v, w in fields)]))
    return answer(rows)


def answer(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()))
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "part", "n", "fields"])


def gathered(packet: pa.Table, widths: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(number of the packet row of every entry, one array per field) of packets that came together."""
    fields = packet.column("fields").to_pylist()
    n = packet.column("n").to_numpy()
    return np.repeat(np.arange(len(n)), n), [np.concatenate([common.unplanes(f[i], w) for f in fields] or [np.empty(0, np.uint64)]) for i, w in enumerate(widths)]


def in_place(t: pa.Table, row: np.ndarray, mark: int, values: np.ndarray, width: int) -> pa.Table:
    """An answer with one value for every key that was asked, in the order in which it was asked: no key is sent back.

    `row` is the packet row of every value, as `gathered` gives it.
    """
    return answer([(mark, p, n, [common.planes(values[a: a + n], width), str(b).encode()]) for p, b, n, a in zip(
        t.column("part").to_pylist(), t.column("bucket").to_pylist(), t.column("n").to_pylist(), np.searchsorted(row, np.arange(t.num_rows)).tolist(), strict=True)])


def read_in_place(got: pa.Table, mark: int, width: int) -> np.ndarray:
    """The values of `in_place` answers for all keys of a part: buckets are key ranges, so their order is that of the keys."""
    rows = [(int(f[1]), f[0]) for m, f in zip(got.column("bucket").to_pylist(), got.column("fields").to_pylist(), strict=True) if m == mark]
    return np.concatenate([common.unplanes(x, width) for _, x in sorted(rows)] or [np.empty(0, np.uint64)])


def ask(docs: DataFrame, question: Callable[[int, pa.Table], pa.Table]) -> DataFrame:
    """Packets that every part sends."""
    return docs.groupBy("part").applyInArrow(lambda key, t: question(key[0].as_py(), t), PACKET)


def ask_again(docs: DataFrame, answers: DataFrame, question: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str = PACKET) -> DataFrame:
    """What every part makes of its documents and the answers that it got."""
    def one(key: tuple, t: pa.Table, got: pa.Table) -> pa.Table:
        return question((key[0] if key else None).as_py(), t, got)

    return docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(one, schema)


def answers(sent: DataFrame, reply: Callable[[pa.Table], pa.Table], parts: int) -> DataFrame:
    """Packets by part: `reply` gets all packets of a bucket. The exchange by bucket has as many partitions as there are parts."""
    return sent.repartition(parts, "bucket").groupBy("bucket").applyInArrow(lambda key, t: reply(t), PACKET)


def split(t: pa.Table, row: np.ndarray, mark: int, fields: list[tuple[np.ndarray, int]]) -> pa.Table:
    """Answers by the part of the packet row that asked."""
    part = t.column("part").to_numpy()
    by = np.argsort(row, kind="stable")
    edges = np.searchsorted(row[by], np.arange(len(part) + 1))
    return answer([(mark, int(p), int(b - a), [common.planes(v[by[a:b]], w) for v, w in fields])
                          for p, a, b in zip(part, edges[:-1], edges[1:], strict=True) if b > a])
