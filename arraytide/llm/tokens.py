"""Token ids of whole texts by the `tokenizers` library, encoding each distinct piece of text once per worker.

A text is cut only where no token of the pre-tokenisers in use can cross: at single white space between other characters. Pieces are looked
up by a 64-bit hash in a per-worker cache and only new ones go through the library; ids are then gathered with numpy. `tests/llm` holds the result
against encoding whole texts directly, also for texts that sums of powers confuse.

A special token of the file (<|endoftext|>) written out in a text is that token, as in the library's own call; no piece is cut inside one, since
they hold no white space, full stop or comma.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from arraytide.llm import common
from arraytide.llm.hashing import chained

CACHE_IDS, LEARN = 8_000_000, 2_000
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def piece_starts(data: np.ndarray, offsets: np.ndarray, with_space: bool) -> np.ndarray:
    """Places where a piece begins: every row's start, after (or, `with_space`, at) a lone ASCII space between other characters, around a lone
    line feed, and at a full stop or comma after a letter.

    Only printable ASCII and U+00C0-U+00FF count as such characters; beside any other the text stays uncut, since it may be white space or a
    combining mark.
    """
    n = len(data)
    heads = offsets[:-1][offsets[:-1] < n]
    if n < 3:
        return np.unique(heads)
    plain = (data > 0x20) & (data < 0x7F)
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    latin = np.zeros(n, bool)  # the second byte of U+00C0-U+00FF
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    lone = (plain | latin)[:-2] & (plain | (data == 0xC3))[2:]
    blank = np.flatnonzero(lone & (data[1:-1] == 0x20)) + 1
    feed = np.flatnonzero(lone & (data[1:-1] == 0x0A)) + 1
    stop = np.flatnonzero((letter | latin & (data != 0x97) & (data != 0xB7))[:-1] & ((data[1:] == 0x2E) | (data[1:] == 0x2C))) + 1
    cuts = np.zeros(n, bool)
    cuts[blank] = True
    if not with_space:
        cuts[blank + 1] = True
    cuts[feed] = True
    cuts[feed + 1] = True
    cuts[stop] = True
    cuts[heads] = True
    return np.flatnonzero(cuts)


class Encoder:
    """One tokenizer and the pieces it has seen. The cache is dropped when full, which costs time and changes nothing."""

    def __init__(self, path: str, with_space: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.with_space = with_space
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.first = np.empty(0, np.int64)
        self.count = np.empty(0, np.uint32)
        self.ids = np.empty(0, np.uint32)

    @staticmethod
    def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
        return [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist(), strict=True)]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        counts, ids = [], []
        for a in range(0, len(pieces), LEARN):  # the library's results are large objects: a few at a time
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[a: a + LEARN], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(counts[-1].sum())))
        count, new = np.concatenate(counts), np.concatenate(ids)
        if len(self.ids) + len(new) > CACHE_IDS:
            self._clear()
        first = np.cumsum(count) - count + len(self.ids)
        self.ids = np.concatenate([self.ids, new])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.first, first), (self.count, count.astype(np.uint32))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows back to back, n + 1 offsets in ids)."""
        n = len(offsets) - 1
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
        start = piece_starts(data, offsets, self.with_space)
        end = np.append(start[1:], len(data))
        distinct, example, back = np.unique(chained(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            before, new = len(self.keys), np.flatnonzero(~known)
            self._learn(distinct[new], self._texts(data, start[example[new]], end[example[new]]))
            if len(self.keys) < before + len(new):  # the cache was dropped: the pieces that were known come again
                old = np.flatnonzero(known)
                self._learn(distinct[old], self._texts(data, start[example[old]], end[example[old]]))
            at = np.searchsorted(self.keys, distinct)
        first, count = self.first[at][back], self.count[at][back].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(first - total[:-1], count)]
        return ids, total[np.searchsorted(start, offsets)]


def encoder(path: str, with_space: bool) -> Encoder:
    if (path, with_space) not in _ENCODERS:
        _ENCODERS[path, with_space] = Encoder(path, with_space)
    return _ENCODERS[path, with_space]


def encoded(batch: pa.RecordBatch, text: str, path: str, with_space: bool, end_id: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ids of each row with `end_id` after them), a few MB of text at a time."""
    data, offsets = common.byte_column(batch.column(text))
    for a, b in common.row_slices(offsets):
        ids, at = encoder(path, with_space).encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
        yield a, [np.append(ids[i:j], np.uint32(end_id)) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
