"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade <= k | text) = sigmoid(threshold_k - w . x): one weight vector shared by all grades, ordered thresholds between them. x holds, with value
1, the hashed distinct words and symbol runs of the text and a few hashed shape features (share of symbols, of digits, of repeated words and
lines, length), so a text of any length is scored in one pass. The model is fitted on at most `max_rows` labelled documents, those with the
smallest hash of their id; nothing else is sampled.

Defined results: a null text is empty and scored by its shape; labels with a null, and labels of unknown documents, are not used; of repeated
labels the lowest grade holds; without labelled documents of two grades there is no model, and every document is selected with null scores; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arraytide.llm import common
from arraytide.llm.hashing import LOWER, SPACE, Substrings, mix

WORD, SYMBOL = 1, 2
CLASS = np.full(256, SYMBOL, np.uint8)
CLASS[SPACE] = 0
CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = WORD
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of maximal runs of one class other than space; runs end with their row."""
    kind = CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets[offsets <= len(data)]] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    keep = kind[start] > 0
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all rows back to back, n + 1 offsets): distinct per row."""
    n = len(offsets) - 1
    start, end, row = _runs(data, offsets)
    words = Substrings(LOWER[data], seed=11).of(start, end)
    size = np.diff(offsets)
    total = np.bincount(row, minlength=n)
    per_row = np.searchsorted(row, np.arange(n + 1))
    kind = CLASS[data]
    sums = {k: np.concatenate([[0], np.cumsum(v)])[offsets] for k, v in (("symbol", kind == SYMBOL), ("digit", DIGIT[data]), ("upper", (data > 64) & (data < 91)))}
    distinct = [np.unique(words[a:b]) for a, b in zip(per_row[:-1].tolist(), per_row[1:].tolist(), strict=True)]
    feeds = np.flatnonzero(data == 10)
    line_row = np.searchsorted(offsets, feeds, "right") - 1
    head = np.concatenate([offsets[:-1], feeds + 1])
    order = np.argsort(head, kind="stable")
    head_row = np.concatenate([np.arange(n), line_row])[order]
    head = head[order]
    tail = np.minimum(np.append(head[1:], len(data)), offsets[head_row + 1])
    lines = mix(Substrings(data, seed=13).of(head, np.maximum(tail, head)) ^ head_row.astype(np.uint64))
    _, first = np.unique(lines, return_index=True)
    fresh_lines = np.bincount(head_row[first], minlength=n)
    shape = np.stack([
        np.minimum(_share(np.diff(sums["symbol"]), size) * 40, 20).astype(int),
        np.minimum(_share(np.diff(sums["digit"]), size) * 40, 20).astype(int),
        np.minimum(_share(np.diff(sums["upper"]), size) * 40, 20).astype(int),
        (_share(np.array([len(x) for x in distinct]), total) * 20).astype(int),
        (_share(fresh_lines, np.bincount(head_row, minlength=n)) * 20).astype(int),
        np.log2(size + 1).astype(int),
        np.minimum(_share(size, total), 20).astype(int),
    ], 1) if n else np.zeros((0, 7), int)
    shaped = mix((np.arange(7) * 1000 + 1_000_003 + shape).astype(np.uint64))
    top = np.uint64(64 - bits)
    rows = [np.unique(np.concatenate([d, s]) >> top) for d, s in zip(distinct, shaped, strict=True)]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return (np.concatenate(rows) if rows else np.empty(0, np.uint64)).astype(np.int64), at


@dataclass
class Model:
    """Weights by feature number (only the fitted ones differ from 0) and ordered thresholds."""
    bits: int
    weights: np.ndarray
    thresholds: np.ndarray

    def position(self, idx: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[idx], dtype=np.float64)])
        return sums[at[1:]] - sums[at[:-1]]

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -40, 40)))


def fit(idx: np.ndarray, at: np.ndarray, grade: np.ndarray, grades: int, bits: int = 18, rounds: int = 200, pull: float = 0.027, rate: float = 0.3,
        least_rows: int = 4) -> Model:
    """Maximum likelihood with an L1 penalty of pull / sqrt(rows), by proximal AdaGrad on the whole sample; features of fewer than `least_rows` rows stay 0."""
    n, size = len(grade), 1 << bits
    l1 = pull / np.sqrt(n)
    seen = np.bincount(idx, minlength=size) >= least_rows
    row = np.repeat(np.arange(n), np.diff(at))
    keep = seen[idx]
    col, row = idx[keep], row[keep]
    w, sq = np.zeros(size), np.full(size, 1e-8)
    share = np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n
    base = np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))
    gaps = np.concatenate([base[:1], np.log(np.maximum(np.diff(base), 0.05))])  # first threshold and logs of the steps up
    gap_sq = np.full(len(gaps), 1e-8)
    for _ in range(rounds):
        theta = np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
        f = np.bincount(row, w[col], n)
        cdf = 1 / (1 + np.exp(np.clip(f[:, None] - theta[None, :], -40, 40)))
        full = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], 1)
        slope = full * (1 - full)
        i = np.arange(n)
        p = np.maximum(full[i, grade + 1] - full[i, grade], 1e-12)
        up, down = slope[i, grade + 1] / p, slope[i, grade] / p
        force = (up - down) / n  # d(-log p)/df
        g = np.bincount(col, force[row], size)
        sq += g * g
        step = rate / np.sqrt(sq)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0) * seen
        d_theta = np.array([(np.where(grade == k + 1, down, 0) - np.where(grade == k, up, 0)).sum() for k in range(grades - 1)]) / n
        d_gaps = np.concatenate([[d_theta.sum()], [d_theta[k:].sum() * np.exp(gaps[k]) for k in range(1, grades - 1)]])
        gap_sq += d_gaps ** 2
        gaps -= rate * d_gaps / np.sqrt(gap_sq)
    return Model(bits, w.astype(np.float32), np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))]))


def train(docs: DataFrame, graded: DataFrame, max_rows: int = 8_000, bits: int = 18, doc_id: str = "doc_id", text: str = "text", **how) -> Model | None:
    """Fit on at most `max_rows` rows of `graded` (doc_id, grade from 0 up); the sample is a bounded table and is sent to the documents."""
    spark = docs.sparkSession
    grades = graded.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    picked = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    picked = spark.createDataFrame([tuple(r) for r in picked.collect()], "doc_id long, grade int")
    sample = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
              .join(F.broadcast(picked), "doc_id"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.byte_column(batch.column("text"))
            for a, b in common.row_slices(offsets):
                idx, at = features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], bits)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("grade").slice(a, b - a),
                                                  pa.array([idx[i:j].astype("<u4").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                                                 ["doc_id", "grade", "idx"])

    # an id may have many rows: one of them learns, so the sample is bounded in rows as it is in labels
    one = sample.mapInArrow(task, "doc_id long, grade int, idx binary").groupBy("doc_id", "grade").agg(F.min("idx").alias("idx"))
    # the lists of features come as one buffer, not as a Python object for each row
    rows = one.toArrow().sort_by("doc_id")
    grade = rows.column("grade").to_numpy().astype(np.int64)
    if len(np.unique(grade)) < 2:
        return None
    data, offsets = common.byte_column(rows.column("idx"))
    return fit(data.view("<u4").astype(np.int64), offsets // 4, grade, int(grade.max()) + 1, bits, **how)


def scored(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("expected_grade", "tails")) -> DataFrame:
    """`docs` with the expected grade (double) and its tails (array<double>: P(grade > 0), P(grade > 1), ...); columns of those names are replaced."""
    docs = docs.select(*(c for c in docs.columns if c not in names))
    used = np.flatnonzero(model.weights)
    small = (model.bits, used.astype(np.int32), model.weights[used], model.thresholds)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(1 << small[0], np.float32)
        w[small[1]] = small[2]
        m = Model(small[0], w, small[3])
        for batch in batches:
            data, offsets = common.byte_column(batch.column(text))
            out = np.concatenate([m.tails(m.position(*features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], m.bits)))
                                  for a, b in common.row_slices(offsets)] or [np.zeros((0, len(m.thresholds)))])
            tails = pa.FixedSizeListArray.from_arrays(pa.array(out.reshape(-1)), out.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.sum(1)), tails], [*batch.schema.names, *names])

    kinds = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(task, kinds)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Graded rating from two yes-no labels: 0 toxic, 1 poor, 2 good; null if a label is."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality).isNotNull() & F.col(toxic).isNotNull(), 2)


def selected(docs: DataFrame, graded: DataFrame, least_tail: float = 0.5, names: tuple[str, str] = ("expected_grade", "tails"), **how) -> DataFrame:
    """The documents whose probability of the highest grade is at least `least_tail`, with expected grade and tails."""
    model = train(docs, graded, **how)
    if model is None:
        return docs.withColumns({names[0]: F.lit(None).cast("double"), names[1]: F.lit(None).cast("array<double>")})
    return scored(docs, model, names=names).where(F.element_at(names[1], -1) >= least_tail)
