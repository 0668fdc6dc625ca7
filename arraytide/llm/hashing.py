"""Hashes of substrings, words and word windows over whole byte arrays (numpy, no per-word Python).

Sums of powers (`Substrings`) serve windows of one width; strings that decide what a text is are hashed by `chained`, since whole families of
texts share sums of powers.
"""
from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def value_table(seed: int) -> np.ndarray:
    """A random 64-bit value per byte."""
    return mix((np.arange(1, 257, dtype=np.uint64) + U(seed) * U(1000003)) * U(0x9E3779B97F4A7C15))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept by the worker and grown when a longer text comes."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[: n + 1]


class Substrings:
    """Hashes of any substring of one byte array, by prefix sums. `base` and `seed` pick the hash function."""

    def __init__(self, data: np.ndarray, seed: int = 1, base: int = BASE):
        self.inverse = powers(pow(base, -1, 1 << 64), len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value_table(seed)[data] * powers(base, len(data))[:-1], out=self.sums[1:], dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of [start, end), its length mixed in."""
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))

    def fixed(self, width: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Hashes of the `width` bytes from each of the places lo..hi."""
        hi = len(self.sums) - width if hi is None else hi
        return mix((self.sums[lo + width: hi + width] - self.sums[lo:hi]) * self.inverse[lo:hi])


LONG = 512  # strings beyond it are hashed one by one
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of bytes outside `parts` ([\\x20\\x09-\\x0D]); a run ends where its row ends."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3
    inside = ~parts[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def chained(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each [start, end), eight bytes a step. A step is one to one in the bytes and in what came before, so strings of up to eight bytes of
    one length never share a hash, and there is no rule by which longer ones do."""
    length = end - start
    at = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))  # the eight bytes from each place on
    out = mix((length + 1).astype(np.uint64) * U(0x9E3779B97F4A7C15))
    for i in np.flatnonzero(length > LONG).tolist():
        out[i] ^= U(int.from_bytes(hashlib.blake2b(data[start[i]: end[i]].tobytes(), digest_size=8).digest(), "little"))
    now, done = np.flatnonzero((length > 0) & (length <= LONG)), 0
    while len(now):
        left = length[now] - done
        out[now] = mix(out[now] ^ (at[start[now] + done] & LOW_BYTES[np.minimum(left, 8)]))
        now, done = now[left > 8], done + 8
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word after A-Z became a-z."""
    start, end, row = word_spans(data, offsets)
    return chained(LOWER[data], start, end), row


def windows(hashes: np.ndarray, row: np.ndarray, rows: int, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word windows; a row of 1 to k - 1 words has one, the whole row."""
    bounds = np.searchsorted(row, np.arange(rows + 1))
    coef = value_table(31)[:k]
    n = max(len(hashes) - k + 1, 0)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += hashes[j: n + j] * coef[j]
    acc = mix(acc)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(acc[a: b - k + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * coef[: b - a]).sum(dtype=np.uint64, keepdims=True) + U(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
