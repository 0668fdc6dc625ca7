"""Removal of repeated byte windows by a depth-limited radix sort of suffixes, most significant digit first.

Suffixes are ordered only through `depth` bytes; groups that are equal there are exactly the repeated windows. Passes go from a coarse digit to
the full depth and drop whatever a pass has settled:

1. the digit is the least-hashed `digit`-byte string of the window (its anchor). Neighbouring windows share their anchor, so a run of windows
   is one entry (digit, hash of the whole run). A digit in one document only is settled: no window of it repeats. A digit whose runs are the
   same bytes everywhere is settled as a whole: all its windows repeat in every document that has it.
2. the bytes of the runs that are left are sent on, and their windows are ordered through all `depth` bytes.

A pass deals digits to buckets; a part of the corpus sends each distinct digit once with its smallest document, and in the second pass each
distinct run, so a passage that a third of the documents hold is one entry per part. Runs of one digit are told apart by 48-bit hashes, digits
by 64-bit and windows by 96-bit ones.

Defined results: a null text is empty; a null doc_id is below every other; rows of equal doc_id do not remove from each other; an empty table
gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common, rounds
from arraytide.llm.hashing import U, Substrings, mix

SECOND = 0xC2B2AE3D27D4EB4F | 1
BLOCK = 1 << 20
PLACE = U(22)  # bits of a place inside a block with its overlap
MIXED = U(0xFFFFFFFFFFFFFFFF)
LOW48 = U((1 << 48) - 1)
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_start array<long>, span_end array<long>"


def order_ids(ids: pa.ChunkedArray) -> np.ndarray:
    """doc ids as unsigned numbers in their order; null first."""
    o = ids.fill_null(0).to_numpy().astype(np.int64).view(np.uint64) ^ U(1 << 63)
    null = np.asarray(ids.is_null().combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids.is_null()).astype(bool)
    return np.where(null, U(0), o)


def _runs(data: np.ndarray, offsets: np.ndarray, depth: int, digit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(digit hash, run hash, first window, last window) of the runs of windows that share an anchor, block by block."""
    n = len(data)
    valid = np.zeros(n + 1, np.int8)
    long = np.diff(offsets) >= depth
    valid[offsets[:-1][long]] += 1
    valid[offsets[1:][long] - depth + 1] -= 1
    valid = np.cumsum(valid, dtype=np.int8)[:n].astype(bool)
    width = depth - digit + 1
    for a in range(0, max(n - depth + 1, 0), BLOCK):
        b = min(a + BLOCK, n - depth + 1)
        s = Substrings(data[a: b + depth - 1])
        h = s.fixed(digit)
        low = (h >> PLACE << PLACE) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[: step - width], low[width - step:])
        anchor = (low & U((1 << 22) - 1)).astype(np.int64)
        ok = valid[a:b]
        edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1]), [True]]))
        first, last = edge[:-1], edge[1:] - 1
        keep = ok[first]
        first, last = first[keep], last[keep]
        yield mix(h[anchor[first]] ^ U(BLOCK)), np.maximum(s.of(first, last + depth) & LOW48, U(1)), first + a, last + a


class Part:
    """The runs of one part, grouped by digit."""

    def __init__(self, t: pa.Table, depth: int, digit: int):
        # a run that crosses a block is cut there, so the rows of a part need the same order in every pass
        t = t.take(pa.compute.sort_indices(t, [("doc_id", "ascending"), ("text", "ascending")]))
        self.ids, self.depth = t.column("doc_id"), depth
        self.data, self.offsets = common.byte_column(t.column("text"))
        self.order = order_ids(t.column("doc_id"))
        found = list(zip(*_runs(self.data, self.offsets, depth, digit), strict=True)) or [(np.empty(0, np.uint64),)] * 2 + [(np.empty(0, np.int64),)] * 2
        h, run, first, last = (np.concatenate(x) for x in found)
        by = np.argsort(h, kind="stable")
        self.h, self.run, self.first, self.last = h[by], run[by], first[by], last[by]
        self.doc = self.order[np.searchsorted(self.offsets, self.first, "right") - 1]
        self.starts = np.flatnonzero(np.concatenate([[True], self.h[1:] != self.h[:-1]])) if len(h) else np.empty(0, np.int64)
        self.group = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(h))))
        self.digits = self.h[self.starts]
        if len(h):
            lo, hi = np.minimum.reduceat(self.run, self.starts), np.maximum.reduceat(self.run, self.starts)
            self.same = np.where(lo == hi, lo, U(0))  # 0: runs of this digit differ inside the part
            self.least = np.minimum.reduceat(self.doc, self.starts)
        else:
            self.same = self.least = np.empty(0, np.uint64)

    def settle(self, got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Per digit: the smallest document of the corpus that has it where its runs are all the same, and whether they differ."""
        least, mixed = self.least.copy(), self.same == 0
        there = np.zeros(len(least), bool)
        _, (h, value) = rounds.gathered(got.filter(pa.compute.equal(got.column("bucket"), -1)), [8, 8])
        at = np.searchsorted(self.digits, h)
        there[at] = value == MIXED
        whole = value != MIXED
        least[at[whole]] = np.minimum(least[at[whole]], value[whole])
        return least, mixed | there

    def windows(self, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, second hash, place, document) of every window of these digits."""
        pick = digits[self.group] if len(self.group) else np.empty(0, bool)
        first, last, doc = self.first[pick], self.last[pick], self.doc[pick]
        one, two, place = _windows(self.data, first, last - first + 1, self.depth)
        return one, two, place, np.repeat(doc, last - first + 1)

    def apart(self, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(runs of these digits in order of digit and content, where each distinct one starts among them)."""
        pick = np.flatnonzero(digits[self.group]) if len(self.group) else np.empty(0, np.int64)
        pick = pick[np.lexsort((self.doc[pick], self.run[pick], self.h[pick]))]
        h, run = self.h[pick], self.run[pick]
        return pick, np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (run[1:] != run[:-1])])) if len(pick) else pick


def _windows(data: np.ndarray, first: np.ndarray, count: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, second hash, place) of `count` windows from each `first` on."""
    place = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
    one, two = np.empty(len(place), np.uint64), np.empty(len(place), np.uint64)
    order = np.argsort(place, kind="stable")
    sorted_place = place[order]
    for a in range(0, len(data), BLOCK):
        i, j = np.searchsorted(sorted_place, [a, a + BLOCK])
        if i < j:
            block = data[a: a + BLOCK + depth - 1]
            at = sorted_place[i:j] - a
            one[order[i:j]] = Substrings(block).of(at, at + depth)
            two[order[i:j]] = Substrings(block, seed=5, base=SECOND).of(at, at + depth) & U(0xFFFFFFFF)
    return one, two, place


def _first_of(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group starts in that order, least document of each group) of equal windows."""
    order = np.lexsort((two, one))
    if not len(order):
        return order, order, doc
    a, b = one[order], two[order]
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return order, starts, np.minimum.reduceat(doc[order], starts)


def _reply_digits(t: pa.Table) -> pa.Table:
    """To every part that has a digit of several parts: MIXED if its runs differ, else the smallest document if that is another part's."""
    row, (h, run, doc) = rounds.gathered(t, [8, 6, 8])
    order = np.argsort(h, kind="stable")
    row, h, run, doc = row[order], h[order], run[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    size = np.diff(np.append(starts, len(h)))
    lo, hi = np.minimum.reduceat(run, starts), np.maximum.reduceat(run, starts)
    least = np.minimum.reduceat(doc, starts)
    value = np.repeat(np.where((lo == hi) & (lo > 0), least, MIXED), size)
    tell = np.repeat(size > 1, size) & ((value == MIXED) | (value < doc))
    return rounds.split(t, row[tell], -1, [(h[tell], 8), (value[tell], 8)])


def _reply_runs(t: pa.Table, depth: int) -> pa.Table:
    """For every run that was sent a bit per window: set if a smaller document of the corpus has the window."""
    row, (_, doc, count) = rounds.gathered(t, [8, 8, 1])
    count = count.astype(np.int64)
    data = np.frombuffer(b"".join(f[3] for f in t.column("fields").to_pylist()), np.uint8)
    size = count + depth - 1
    one, two, _ = _windows(data, np.cumsum(size) - size, count, depth)
    doc_of = np.repeat(doc, count)
    order, starts, least = _first_of(one, two, doc_of)
    repeats = np.empty(len(order), bool)
    repeats[order] = np.repeat(least, np.diff(np.append(starts, len(order)))) < doc_of[order]
    begin = np.cumsum(count) - count
    bit = (np.arange(len(repeats)) - np.repeat(begin, count)).astype(np.uint64)
    masks = np.add.reduceat(repeats.astype(np.uint64) << bit, begin)
    return rounds.in_place(t, row, -2, masks, 8)


def remove_repeats(docs: DataFrame, depth: int = 50, digit: int = 20, doc_id: str = "doc_id", text: str = "text", part_bytes: int = 8 << 20) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (bytes, end exclusive).

    Removed is every byte covered by a window of `depth` bytes that also starts in a document with a smaller doc_id.
    """
    if not 0 <= depth - digit < 64:
        raise ValueError("a run holds at most 64 windows: choose a digit of at least depth - 63 bytes")
    parts = common.parts_for(docs, text, part_bytes)
    held = rounds.parted(docs, parts, doc_id, text)

    def digits(part: int, t: pa.Table) -> pa.Table:
        p = Part(t, depth, digit)
        return rounds.packets(part, p.digits, [(p.same, 6), (p.least, 8)], parts)

    def runs(part: int, t: pa.Table, got: pa.Table) -> pa.Table:
        p = Part(t, depth, digit)
        pick, starts = p.apart(_told(p, got))
        one = pick[starts]  # of equal runs the one in the smallest document
        sent = rounds.packets(part, p.h[one], [(p.doc[one], 8), ((p.last - p.first + 1)[one].astype(np.uint64), 1)], parts)
        # the bytes of the runs go with the packet of their bucket
        at, fields = 0, []
        for n, f in zip(sent.column("n").to_pylist(), sent.column("fields").to_pylist(), strict=True):
            fields.append([*f, b"".join(p.data[i:j].tobytes() for i, j in zip(p.first[one[at: at + n]], p.last[one[at: at + n]] + depth, strict=True))])
            at += n
        return sent.set_column(3, "fields", pa.array(fields, pa.list_(pa.binary())))

    def _told(p: Part, got: pa.Table) -> np.ndarray:
        """The digits that differ between parts: only their windows go on."""
        _, (h, value) = rounds.gathered(got.filter(pa.compute.equal(got.column("bucket"), -1)), [8, 8])
        out = np.zeros(len(p.digits), bool)
        out[np.searchsorted(p.digits, h[value == MIXED])] = True
        return out

    def finish(part: int, t: pa.Table, got: pa.Table) -> pa.Table:
        p = Part(t, depth, digit)
        least, mixed = p.settle(got)
        whole = ~mixed[p.group] & (p.doc > least[p.group]) if len(p.group) else np.empty(0, bool)
        one, two, place, doc = p.windows(mixed)
        order, starts, local = _first_of(one, two, doc)
        sizes = np.diff(np.append(starts, len(order)))
        again = doc[order] > np.repeat(local, sizes)
        # what other parts say about runs: equal runs of one part share the answer, since only its smallest document was compared
        pick, begins = p.apart(_told(p, got))
        masks = np.repeat(rounds.read_in_place(got, -2, 8), np.diff(np.append(begins, len(pick))))
        far = np.concatenate([(p.first[pick] + j)[(masks >> U(j) & U(1)).astype(bool)] for j in range(depth - digit + 1)])
        begin = np.concatenate([p.first[whole], place[order[again]], far])
        end = np.concatenate([p.last[whole], place[order[again]], far]) + depth
        n = len(p.data)
        cover = np.zeros(n + 1, np.int32)
        np.add.at(cover, begin, 1)
        np.subtract.at(cover, end, 1)
        gone = np.cumsum(cover, dtype=np.int32)[:n] > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        heads = p.offsets[:-1][p.offsets[:-1] < n]
        head[heads] = gone[heads]
        tail = gone.copy()
        tail[:-1] &= ~gone[1:]
        tails = p.offsets[1:][p.offsets[1:] > 0] - 1
        tail[tails] = gone[tails]
        span_a, span_b = np.flatnonzero(head), np.flatnonzero(tail) + 1
        at = np.searchsorted(span_a, p.offsets)
        removed = np.concatenate([[0], np.cumsum(gone)])[p.offsets]
        kept = [hashlib.sha256(p.data[i:j][~gone[i:j]].tobytes()).hexdigest() for i, j in zip(p.offsets[:-1].tolist(), p.offsets[1:].tolist(), strict=True)]
        own = np.repeat(p.offsets[:-1], np.diff(at))
        lists = [pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(x - own)).cast(pa.list_(pa.int64())) for x in (span_a, span_b)]
        return pa.Table.from_arrays([p.ids, pa.array(np.diff(p.offsets)), pa.array(np.diff(removed)), pa.array(np.diff(at)), pa.array(kept), *lists],
                                    [x.split()[0] for x in KEPT.split(", ")])

    first = rounds.answers(rounds.ask(held, digits), _reply_digits, parts)
    second = rounds.answers(rounds.ask_again(held, first, runs), lambda t: _reply_runs(t, depth), parts)
    return rounds.ask_again(held, first.unionByName(second), finish, KEPT)


def kept_text(docs: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` (unique ids) with the removed bytes cut out of their texts; what is left of a character that was cut in half becomes U+FFFD."""
    body = F.col(text).cast("binary")
    pieces = F.transform(F.sequence(F.lit(0), F.size("span_start")), lambda i: F.substring(
        body, F.when(i == 0, 0).otherwise(F.get("span_end", i - 1)).cast("int") + 1,
        (F.when(i == F.size("span_start"), F.octet_length(body).cast("long")).otherwise(F.get("span_start", i))
         - F.when(i == 0, 0).otherwise(F.get("span_end", i - 1))).cast("int")))
    joined = F.aggregate(pieces, F.lit(b""), lambda acc, x: F.concat(acc, x))
    rest = docs.join(removed.select(doc_id, "span_start", "span_end"), doc_id)
    clean = F.when(F.size("span_start") > 0, F.make_valid_utf8(joined.cast("string"))).otherwise(F.col(text))
    return rest.withColumn(text, clean).select(*docs.columns)
