"""Language-model scoring with a weighted backoff automaton learned from the corpus.

States are the contexts of the smoothed n-grams (up to `order` - 1 tokens). A state has an arc per token seen after it and a failure arc to the
next shorter context; the empty context has an arc for every token, unknown ones together. With c the training counts, the arc of w at u weighs

    P(w | u) = (1 - f(u)) c(u w) / c(u) + f(u) P(w | u less its first token),    f(u) = (c(u) + 1) ** -`share`,
    P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),

and the failure arc f(u); a context that training lacks passes everything on. The weights of a state sum to one, so scores of all tokens of a
text are log10 probabilities. A text is read from left to right once: the state is the longest context that training holds. All positions of
a part are advanced together in numpy, one order after another.

Counts cover all training documents. A part learns the counts of the n-grams in its own documents in one round of packets. Defined results: a null text is empty (one end token); a null doc_id is hashed as the empty text; repeated rows count
and are scored each; an empty table gives no rows; with no training document every token is unknown.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common, rounds
from arraytide.llm.hashing import U, mix, value_table, words

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
END = U(0x5851F42D4C957F2D)


def held_out(ids: pa.ChunkedArray, folds: int = 5, fold: int = 1) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == fold for i in ids.to_pylist()], bool)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words of every row and one end token after them."""
    hashes, rows = [], []
    for a, b in common.row_slices(offsets):
        h, row = words(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
        last = np.searchsorted(row, np.arange(b - a), "right")
        hashes.append(np.insert(h, last, END))
        rows.append(np.insert(row, last, np.arange(b - a)) + a)
    return (np.concatenate(hashes), np.concatenate(rows)) if hashes else (np.empty(0, np.uint64), np.empty(0, np.int64))


class Grams:
    """The n-grams of one part: distinct keys of all orders, their own training counts, and where each token's n-gram of each order is."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, training: np.ndarray, order: int):
        self.h, self.row = tokens(data, offsets)
        coef, keys, self.at = value_table(41), [], []
        for k in range(1, order + 1):
            n = max(len(self.h) - k + 1, 0)
            key = np.full(n, k, np.uint64)
            for j in range(k):
                key += self.h[j: j + n] * coef[8 * k + j]
            ok = self.row[:n] == self.row[k - 1:]
            keys.append(mix(key[ok]))
            self.at.append(np.flatnonzero(ok) + k - 1)  # the token that ends the n-gram
        self.keys, back = np.unique(np.concatenate(keys), return_inverse=True)
        learns = training[self.row]
        self.counts = np.bincount(back, np.concatenate([learns[a] for a in self.at]), len(self.keys)).astype(np.uint64)
        self.index = np.split(back, np.cumsum([len(a) for a in self.at])[:-1])


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[int, int]:
    """(tokens, distinct tokens) of the training documents, ends counted."""
    buckets = common.parts_for(docs, text, 32 << 20)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.byte_column(batch.column("text"))
            h, row = tokens(data, offsets)
            h = h[~held_out(batch.column("doc_id"))[row]]
            yield from rounds.packets(0, np.unique(h), [], buckets).to_batches()
            # the count of a batch goes beside one of the buckets, so that no single group gets them all
            yield from rounds.answer([(int(h[0] >> U(32)) * buckets >> 32, 0, len(h), [])] if len(h) else []).to_batches()

    def distinct(key: tuple, t: pa.Table) -> pa.Table:
        counted = pa.compute.equal(pa.compute.list_value_length(t.column("fields")), 0)
        n = pa.compute.sum(t.filter(counted).column("n")).as_py() or 0
        v = len(np.unique(rounds.gathered(t.filter(pa.compute.invert(counted)), [8])[1][0]))
        return pa.table({"n": pa.array([n], pa.int64()), "v": pa.array([v], pa.int64())})

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text")).mapInArrow(ask, rounds.PACKET)
    both = t.groupBy("bucket").applyInArrow(distinct, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return int(both["n"] or 0), int(both["v"] or 0)


def _counts(t: pa.Table) -> pa.Table:
    """For every key that was asked what other parts add to its training count."""
    row, (key, count) = rounds.gathered(t, [8, 4])
    by = np.argsort(key, kind="stable")
    sorted_key, sorted_count = key[by], count[by]
    starts = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
    more = np.empty(len(key), np.uint64)
    more[by] = np.repeat(np.add.reduceat(sorted_count, starts), np.diff(np.append(starts, len(key)))) - sorted_count
    return rounds.in_place(t, row, -1, more, 6)


def score(docs: DataFrame, order: int = 2, share: float = 0.05, doc_id: str = "doc_id", text: str = "text", part_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams alone), score (the automaton)."""
    total, distinct = vocabulary(docs, doc_id, text)
    log_z = float(np.log10(total + 0.5 * (distinct + 1)))
    parts = common.parts_for(docs, text, part_bytes)
    held = rounds.parted(docs, parts, doc_id, text)

    def grams(t: pa.Table) -> tuple[Grams, np.ndarray]:
        out = held_out(t.column("doc_id"))
        return Grams(*common.byte_column(t.column("text")), ~out, order), out

    def ask(part: int, t: pa.Table) -> pa.Table:
        g, _ = grams(t)
        return rounds.packets(part, g.keys, [(np.minimum(g.counts, U(0xFFFFFFFF)), 4)], parts)

    def finish(part: int, t: pa.Table, got: pa.Table) -> pa.Table:
        g, out = grams(t)
        counts = (g.counts + rounds.read_in_place(got, -1, 6)).astype(np.float64)
        rows, size = len(out), len(g.h)
        c = np.zeros(size)
        c[g.at[0]] = counts[g.index[0]]
        base = np.log10(c + 0.5) - log_z
        p = 10.0 ** base
        context = np.zeros(size)  # count of the n-gram of the last order that ends at each token
        context[g.at[0]] = c
        for k in range(2, order + 1):
            here, seen = g.at[k - 1], counts[g.index[k - 1]]
            before = context[here - 1]
            fail = (before + 1) ** -share
            known = before > 0
            p[here] = np.where(known, (1 - fail) * seen / np.maximum(before, 1) + fail * p[here], p[here])
            context = np.zeros(size)
            context[here] = seen
        return pa.table({"doc_id": t.column("doc_id"), "held_out": pa.array(out), "n_tokens": pa.array(np.bincount(g.row, minlength=rows).astype(np.int64)),
                         "n_known": pa.array(np.bincount(g.row, c > 0, rows).astype(np.int64)), "train_tokens": pa.array(np.full(rows, total, np.int64)),
                         "base_score": pa.array(np.bincount(g.row, base, rows)), "score": pa.array(np.bincount(g.row, np.log10(p), rows))})

    return rounds.ask_again(held, rounds.answers(rounds.ask(held, ask), _counts, parts), finish, SCORES)
