"""Removal of repeated byte strings: a byte goes when a string of ``size`` bytes that covers it also starts elsewhere.

The suffixes of the corpus, cut at ``size`` bytes ("windows"), are split by four keys in turn, and after each pass groups of one
are dropped; the groups equal after the last key are the repeated windows. No suffix is ordered: buckets by a content-picked
anchor and hash counts stand in for most-significant-digit passes, which would have an entry per byte. The keys:

1. the window's anchor: the least of its hashed ``GRAM``-byte strings and its place in the window. Neighbouring windows
   share their anchor, so a run of windows with one anchor ("span") is one entry of this pass, about one per 90 bytes;
2. the whole span, for spans whose anchor occurs twice or more: if the same span occurs again, all its windows repeat;
3. the first half of each window, for spans that are alone with their bytes but not with their anchor;
4. the whole window, where that first half occurs twice or more.

Each pass is a count over the corpus (``blocks.count``); a document takes its own answers back. Keys are compared as 64-bit
polynomial hashes of their bytes, several of them for each window. Matches never cross documents; they are judged on the
input, so overlapping repeats all go.

Defined cases: a NULL text is an empty text (a NULL stays NULL in the output); a text shorter than ``size`` bytes loses
nothing; a repeated row repeats its text, so both rows lose all bytes in windows; an empty table gives no row. Cut texts are read as UTF-8
and characters cut in two are dropped.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import blocks as B
from .text_arrays import GOLDEN, U, Docs, chunks, distinct, mix, tally

SIZE = 200
GRAM = 24
ANCHOR, SPAN, HALF, WINDOW = 1, 2, 3, 4
CHUNK = 2 << 20
_BASE = U(0xC2B2AE3D27D4EB4F)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        base = np.full(max(n, CHUNK + 1024), _BASE if which == "base" else _INVERSE, np.uint64)
        base[0] = U(1)
        have = _powers[which] = np.multiply.accumulate(base)
    return have[:n]


class Hashes:
    """Polynomial hashes of any range of a chunk's bytes."""

    def __init__(self, data: np.ndarray):
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * _power("base", len(data)), out=self.sum[1:])
        self.inverse = _power("inverse", len(data) + 1)

    def at(self, start: np.ndarray | slice, length) -> np.ndarray:
        end = slice(start.start + length, start.stop + length) if isinstance(start, slice) else start + length
        return mix((self.sum[end] - self.sum[start]) * self.inverse[start])


class Spans(NamedTuple):
    """Runs of windows ``lo .. hi`` (chunk positions) with one anchor, and the hashes of the first two digits."""

    lo: np.ndarray
    hi: np.ndarray
    anchor: np.ndarray
    span: np.ndarray


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by prefix and suffix minima of stretches of that width."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(rows, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def spans(docs: Docs, hashes: Hashes, size: int, gram: int) -> Spans:
    none = np.zeros(0, np.int64)
    n = len(docs.data)
    if n < size:
        return Spans(none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = hashes.at(slice(0, n - gram + 1), gram)
    bits = U(max(1, int(n).bit_length()))
    placed = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
    best = (_sliding_least(placed, size - gram + 1) & ((U(1) << bits) - U(1))).astype(np.int64)
    start = np.arange(n - size + 1)
    length = np.diff(docs.off)
    valid = np.zeros(n + 1, np.int64)
    long = length >= size
    np.add.at(valid, docs.off[:-1][long], 1)
    np.add.at(valid, docs.off[1:][long] - size + 1, -1)
    inside = np.cumsum(valid)[:n - size + 1] > 0
    first = inside.copy()
    first[1:] &= (best[1:] != best[:-1]) | ~inside[:-1]
    first[docs.off[:-1][long]] = True
    last = np.zeros(len(inside), bool)
    last[:-1] = inside[:-1] & (first[1:] | ~inside[1:])
    last[-1] = inside[-1]
    lo, hi = start[first], start[last]
    at = best[lo]
    whole = hashes.at(lo, hi - lo + size)
    return Spans(lo, hi, mix(grams[at]), mix(whole + mix(((hi - lo) * 65536 + at - lo).astype(np.uint64))))


def _windows(s: Spans, which: np.ndarray) -> np.ndarray:
    """The window starts of the spans ``which``."""
    n = s.hi[which] - s.lo[which] + 1
    ends = np.cumsum(n)
    return np.repeat(s.lo[which] - ends + n, n) + np.arange(ends[-1] if len(n) else 0)


class _Block:
    """The chunks of a block with their spans."""

    def __init__(self, rows: pa.Table, size: int, gram: int):
        self.size, self.parts = size, []
        for docs in chunks(rows["text"], CHUNK):
            h = Hashes(docs.data)
            self.parts.append((docs, h, spans(docs, h, size, gram)))

    def keys(self, kind: int) -> np.ndarray:
        have = [s.anchor if kind == ANCHOR else s.span for _, _, s in self.parts]
        return np.concatenate(have) if have else np.zeros(0, np.uint64)

    def sort(self, totals: dict[int, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By chunk: the spans that occur again; those alone with an anchor that does not; those to compare with the latter."""
        known = {k: distinct(self.keys(k)) for k in (ANCHOR, SPAN)}
        out, seen = [], np.zeros(0, np.uint64)
        for _, _, s in self.parts:
            anchor = totals[ANCHOR][np.searchsorted(known[ANCHOR], s.anchor)] if len(s.anchor) else s.anchor
            span = totals[SPAN][np.searchsorted(known[SPAN], s.span)] if len(s.span) else s.span
            mixed = (span >= 2) & (anchor > span)
            once = np.zeros(len(mixed), bool)  # one copy of a repeated span is enough to compare with
            _, first = np.unique(s.span[mixed], return_index=True)
            once[np.flatnonzero(mixed)[first]] = True
            out.append((np.flatnonzero(span >= 2), np.flatnonzero((span == 1) & (anchor > 1)), np.flatnonzero(once)))
        return out

    def halves(self, totals) -> list[tuple[Hashes, np.ndarray, np.ndarray, np.ndarray]]:
        """By chunk: hashes, windows to judge, windows to compare with, and the key of the first half of either."""
        out = []
        for (_, h, s), (_, alone, other) in zip(self.parts, self.sort(totals), strict=True):
            mine, rest = _windows(s, alone), _windows(s, other)
            label = np.concatenate([np.repeat(s.anchor[w] + U(1), s.hi[w] - s.lo[w] + 1) for w in (alone, other)])
            out.append((h, mine, rest, mix(h.at(np.concatenate([mine, rest]), self.size // 2) + label)))
        return out

    def wholes(self, totals) -> list[tuple[np.ndarray, np.ndarray]]:
        """By chunk: windows to judge and the keys of those and of the windows to compare with, where the half repeats."""
        have = self.halves(totals)
        known = distinct(np.concatenate([k for *_, k in have])) if have else np.zeros(0, np.uint64)
        out = []
        for h, mine, rest, key in have:
            again = totals[HALF][np.searchsorted(known, key)] >= 2 if len(key) else np.zeros(0, bool)
            at = np.concatenate([mine, rest])[again]
            out.append((mine[again[:len(mine)]], mix(h.at(at, self.size) + key[again])))
        return out


def _tallied(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return tally(np.concatenate(keys) if keys else np.zeros(0, np.uint64))


def removals(packed: B.Blocks, size: int = SIZE, gram: int = GRAM):
    """The answers of the four passes and a function that gives, for a block, each chunk and its removed bytes."""
    if not 0 < gram <= size:
        raise ValueError("an anchor must fit a window")

    def first(rows, _):
        b = _Block(rows, size, gram)
        return {k: _tallied([b.keys(k)]) for k in (ANCHOR, SPAN)}

    def half(rows, totals):
        return {HALF: _tallied([k for *_, k in _Block(rows, size, gram).halves(totals)])} if totals else {}

    def whole(rows, totals):
        return {WINDOW: _tallied([k for _, k in _Block(rows, size, gram).wholes(_full(totals))])} if totals else {}

    def _full(totals):
        return {k: totals.get(k, np.zeros(0, np.uint64)) for k in (ANCHOR, SPAN, HALF, WINDOW)}

    answers = B.count(packed, first, name="repeat_spans")
    answers = B.merged(answers, B.count(packed, half, answers, name="repeat_halves"))
    answers = B.merged(answers, B.count(packed, whole, answers, name="repeat_windows"))

    def removed(rows: pa.Table, totals: dict[int, np.ndarray]) -> list[tuple[Docs, np.ndarray]]:
        totals = _full(totals)
        block = _Block(rows, size, gram)
        judged = block.wholes(totals)
        known = distinct(np.concatenate([k for _, k in judged])) if judged else np.zeros(0, np.uint64)
        out = []
        for (docs, _, s), (again, _, _), (mine, key) in zip(block.parts, block.sort(totals), judged, strict=True):
            change = np.zeros(len(docs.data) + 1, np.int32)
            np.add.at(change, s.lo[again], 1)
            np.add.at(change, s.hi[again] + size, -1)
            if len(mine):
                hit = mine[totals[WINDOW][np.searchsorted(known, key[:len(mine)])] >= 2]
                np.add.at(change, hit, 1)
                np.add.at(change, hit + size, -1)
            out.append((docs, np.cumsum(change[:-1]) > 0))
        return out

    return answers, removed


CUT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                    T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])


def _runs(docs: Docs, gone: np.ndarray) -> np.ndarray:
    """Maximal removed runs by document."""
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    starts = docs.off[:-1][docs.off[:-1] < len(gone)]
    first[starts] = gone[starts]
    return np.diff(np.concatenate([[0], np.cumsum(first)])[docs.off])


def _kept(docs: Docs, gone: np.ndarray) -> list[bytes]:
    return [docs.data[a:b][~gone[a:b]].tobytes() for a, b in zip(docs.off[:-1], docs.off[1:], strict=True)]


def summary(docs: DataFrame, id_columns: list[str], size: int = SIZE) -> DataFrame:
    """``id_columns`` and ``n_bytes, n_removed, n_spans, kept_sha256`` (of the bytes that stay) of each document."""
    packed = B.pack(docs.select(*id_columns, "text"))
    answers, removed = removals(packed, size)

    def run(rows: pa.Table, totals: dict[int, np.ndarray], _: int) -> pa.Table:
        cols: list[list] = [[], [], [], []]
        for d, gone in removed(rows, totals):
            cols[0] += np.diff(d.off).tolist()
            cols[1] += np.diff(np.concatenate([[0], np.cumsum(gone)])[d.off]).tolist()
            cols[2] += _runs(d, gone).tolist()
            cols[3] += [hashlib.sha256(x).hexdigest() for x in _kept(d, gone)]
        new = [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())]
        return pa.table([*[rows[c] for c in id_columns], *new], names=[*id_columns, *CUT.names])

    return B.answered(packed, answers, run, T.StructType([docs.schema[c] for c in id_columns] + CUT.fields))


def without_repeats(docs: DataFrame, size: int = SIZE, text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``; other columns and rows stay."""
    names = docs.columns
    at = names.index(text)
    inner = docs.toDF(*["text" if i == at else f"c{i}" for i in range(len(names))])
    packed = B.pack(inner)
    answers, removed = removals(packed, size)

    def run(rows: pa.Table, totals: dict[int, np.ndarray], _: int) -> pa.Table:
        new = []
        for d, gone in removed(rows, totals):
            new += [x.decode("utf-8", "ignore") for x in _kept(d, gone)]
        whole = rows["text"].combine_chunks()
        cut = pa.array(new, pa.string(), mask=whole.is_null().to_numpy(zero_copy_only=False))
        return rows.set_column(at, rows.schema.field(at), cut.cast(rows.schema.field(at).type))

    return B.answered(packed, answers, run, inner.schema).toDF(*names)
