"""Best-fit packing by linear grouping: documents as token sequences of one length, as few sequences as the scheme can.

Lengths are whole numbers up to the capacity, so the corpus enters the scheme as a histogram of at most `capacity` counts and the plan leaves
it as runs (so many documents of one length go to so many sequences in a row at one offset). Both are bounded whatever the corpus holds; the
documents are matched to runs by their rank within their length in one join.

Scheme: lengths over `small_share` of the capacity are put into groups of equal cardinality and rounded up to the largest of their group;
configurations of the few rounded sizes are chosen one after another, each the fullest that starts with the largest size left, as often as the
counts allow; actual documents replace the rounded ones, longest first; small documents then go, longest first, where they fit best.

Defined results: a null text is empty and makes one piece of one end id; null or repeated ids are packed row by row; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arraytide.llm import common, tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RUNS = "length long, rank_from long, rank_to long, sequence_from long, offset long"


def cut(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_space: bool = True, doc_id: str = "doc_id",
        text: str = "text") -> DataFrame:
    """The pieces of every document; only longer ones are cut, and then the first piece takes what is over."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, found in tokens.encoded(batch, "text", tokenizer, with_space, end_id):
                rows: list[tuple] = []
                for own, ids in zip(batch.column("doc_id").slice(a, len(found)).to_pylist(), found, strict=True):
                    first = (len(ids) - 1) % capacity + 1
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    rows += [(own, k, i, j - i, tokens.crc(ids[i:j])) for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False))]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text")).mapInArrow(task, PIECES)


@dataclass
class _Plan:
    """Runs so far. `taken` is the number of documents of each length that have a place."""
    capacity: int
    runs: list[tuple] = field(default_factory=list)
    sequences: int = 0
    taken: dict[int, int] = field(default_factory=dict)
    room: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def place(self, length: int, count: int, first: int, offset: int) -> None:
        rank = self.taken.get(length, 0)
        self.runs.append((length, rank, rank + count, first, offset))
        self.taken[length] = rank + count

    def leave(self, free: int, first: int, count: int) -> None:
        if free and count:
            self.room.setdefault(free, []).append((first, count))


def _groups(large: list[tuple[int, int]], n: int) -> list[list[tuple[int, int]]]:
    """(length, count) runs, longest first, dealt into n groups of equal cardinality; a run that crosses an edge is split."""
    total = sum(c for _, c in large)
    quota, out, own, held = -(-total // n) if total else 1, [], [], 0
    for length, count in large:
        while count:
            step = min(count, quota - held)
            own.append((length, step))
            held, count = held + step, count - step
            if held == quota:
                out, own, held = [*out, own], [], 0
    return [*out, own] if own else out


def _fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size the fullest configuration takes that holds the first size left (sizes descend); ties prefer larger sizes."""
    first = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[first]
    # reach[k]: bit b set if sizes k.. can fill exactly b; built from the smallest up
    usable = [(i, min(left[i] - (i == first), room // sizes[i])) for i in range(first, len(sizes)) if left[i] and sizes[i] <= room]
    reach = [1]
    mask = (1 << (room + 1)) - 1
    for i, most in reversed(usable):
        bits, add = reach[-1], reach[-1]
        for _ in range(most):
            add = (add << sizes[i]) & mask
            bits |= add
        reach.append(bits)
    reach.reverse()
    fill = reach[0].bit_length() - 1
    take = [0] * len(sizes)
    take[first] = 1
    for k, (i, most) in enumerate(usable):
        for q in range(min(most, fill // sizes[i]), -1, -1):
            if reach[k + 1] >> (fill - q * sizes[i]) & 1:
                take[i] += q
                fill -= q * sizes[i]
                break
    return take


def plan(histogram: dict[int, int], capacity: int = 2048, small_share: float = 0.4, groups: int = 1024) -> tuple[list[tuple], int]:
    """(runs, number of sequences) for {length: count}. More groups round less and search longer. Work and result depend on the distinct lengths, not on the counts."""
    p = _Plan(capacity)
    large = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if n > capacity * small_share and histogram[n]]
    grouped = _groups(large, groups)
    sizes, left = [g[0][0] for g in grouped], [sum(c for _, c in g) for g in grouped]
    queues = [list(reversed(g)) for g in grouped]
    while any(left):
        take = _fullest(sizes, left, capacity)
        times = min(n // q for n, q in zip(left, take, strict=True) if q)
        # the slots of this configuration, each a list of (length, count) over its sequences
        slots = []
        for i, q in enumerate(take):
            left[i] -= q * times
            for _ in range(q):
                need, own = times, []
                while need:
                    length, count = queues[i].pop()
                    step = min(count, need)
                    own.append((length, step))
                    if count > step:
                        queues[i].append((length, count - step))
                    need -= step
                slots.append(own)
        done = 0
        while done < times:
            step, offset = min(s[0][1] for s in slots), 0
            for s in slots:
                length, count = s[0]
                p.place(length, step, p.sequences + done, offset)
                offset += length
                if count == step:
                    s.pop(0)
                else:
                    s[0] = (length, count - step)
            p.leave(capacity - offset, p.sequences + done, step)
            done += step
        p.sequences += times
    for length in sorted((n for n in histogram if n <= capacity * small_share and histogram[n]), reverse=True):
        count = histogram[length]
        while count:
            free = next((f for f in range(length, capacity) if p.room.get(f)), None)
            if free is None:
                free, first, there = capacity, p.sequences, -(-count // (capacity // length))
                p.sequences += there
            else:
                first, there = p.room[free].pop()
            # the best fit stays the best until it is full, so each sequence takes as many as it can
            each = free // length
            whole = min(there, count // each)
            for k in range(each if whole else 0):
                p.place(length, whole, first, capacity - free + k * length)
            p.leave(free - each * length, first, whole)
            count -= whole * each
            if whole < there and count:
                for k in range(count):
                    p.place(length, 1, first + whole, capacity - free + k * length)
                p.leave(free - count * length, first + whole, 1)
                count, whole = 0, whole + 1
            p.leave(free, first + whole, there - whole)
    return p.runs, p.sequences


def assign(pieces: DataFrame, capacity: int = 2048, small_share: float = 0.4, groups: int = 1024, shard_rows: int = 200_000) -> DataFrame:
    """`pieces` (a stored table) with sequence_id and offset. One length may hold most rows: ranks are taken per shard of about `shard_rows` pieces and
    carried over; the most frequent length sets the number of shards."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    shards = max(histogram.values(), default=0) // shard_rows + 1
    runs, _ = plan(histogram, capacity, small_share, groups)
    table = spark.createDataFrame([tuple(map(int, r)) for r in runs], RUNS)
    own = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    before = own.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))  
    before = before.select("length", "shard", (F.sum("n").over(Window.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = own.withColumn("inside", inside).join(before, ["length", "shard"]).withColumn("rank", F.col("before") + F.col("inside"))
    # the runs are bounded by the capacity, whatever the corpus holds
    placed = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32",
                         (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_space: bool = True, doc_id: str = "doc_id", text: str = "text",
         small_share: float = 0.4, groups: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    pieces = common.stored(cut(docs, tokenizer, capacity, end_id, with_space, doc_id, text), "pieces")
    return assign(pieces, capacity, small_share, groups)
