"""Vectorised views on Arrow string columns, used inside tasks.

A chunk of documents is seen as one byte array with document offsets; words, their 64-bit hashes and shingle hashes
are NumPy arrays over it. A NULL text is an empty text. Chunks are bounded by bytes, so the temporary arrays are
bounded too (one very long document is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 4 << 20
LONG_WORD = 64

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 (wraps around on purpose)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting, which is faster here than NumPy's hashing)."""
    s = np.sort(x)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def tally(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    s = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[at], np.diff(np.append(at, len(s)))


class Docs(NamedTuple):
    """Documents ``lo .. lo + len(off) - 1`` of a batch: their bytes one after another and ``len + 1`` offsets."""

    lo: int
    data: np.ndarray
    off: np.ndarray

    def text(self, d: int) -> bytes:
        return self.data[self.off[d]:self.off[d + 1]].tobytes()


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Docs]:
    """A string column as chunks of at most ``limit`` bytes (one document at least)."""
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for a in arrays:
        if a.null_count:
            a = a.fill_null("")
        if len(a):
            wide = pa.types.is_large_string(a.type)
            off = np.frombuffer(a.buffers()[1], np.int64 if wide else np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
            raw = a.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
            lo = 0
            while lo < len(a):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
                hi = min(hi, len(a))
                yield Docs(base + lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                lo = hi
        base += len(a)


class Words(NamedTuple):
    """Words ``[^\\x20\\x09-\\x0D]+``: first and last byte + 1 of each, and the range of each document's words."""

    start: np.ndarray
    end: np.ndarray
    off: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray, space: np.ndarray = _SPACE) -> Words:
    """``space``: for each byte value, whether it separates words."""
    inside = ~space[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    first = off[:-1][off[:-1] < n]
    before[first] = False
    after[first[first > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return Words(start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, off))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = w.end - w.start
    out = mix(length.astype(np.uint64) * GOLDEN)
    at = np.flatnonzero(length <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        if k:
            at = at[length[at] > k]
        if not len(at):
            break
        part = eight[w.start[at] + k] & _MASK[np.minimum(length[at] - k, 8)]
        out[at] = mix((out[at] ^ part) * U(0x2545F4914F6CDD1D) + GOLDEN)
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[w.start[i]:w.end[i]].tobytes())
    return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` values, starting at each value but the last ``n - 1``."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(m, (int(GOLDEN) * n) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(n):
        acc += mix(hashes[k:k + m] + U(k)) * _ODD[k % 8]
    return mix(acc)


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its runs of ``size`` words; of fewer words, of them all."""
    w = words(data, off)
    h = word_hashes(data, w)
    every = ngrams(h, size)
    out = []
    for a, b in zip(w.off[:-1].tolist(), w.off[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(distinct(every[a:b - size + 1]))
        else:
            out.append(ngrams(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
