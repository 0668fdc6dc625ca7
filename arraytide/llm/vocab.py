"""Words of many texts as exact codes: equal codes are equal bytes, whatever the words look like."""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from arraytide.llm.hashing import LOWER, word_spans


def outside(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values in `ranges` (ends included): those that part words."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a: b + 1] = True
    return out


# what is left after A-Z became a-z: letters, digits and everything beyond ASCII; the same without digits
NOT_WORD = outside((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
NOT_TERM = outside((0x00, 0x60), (0x7B, 0x7F))


def coded(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code, words by code, row) of the words of all rows, lower-cased in A-Z."""
    data = LOWER[data]
    start, end, row = word_spans(data, offsets, parts)
    return *codes(data[~parts[data]], np.concatenate([[0], np.cumsum(end - start)])), row


def codes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code, strings by code) of the strings between one edge of `data` and the next."""
    found = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary
