"""Benchmark decontamination by the q-gram lemma.

A document region within ``e`` edits of a passage of ``m`` bytes shares at least ``m - q + 1 - q * e`` of its q-grams,
and all of them lie on diagonals (document position minus passage position) at most ``e`` apart. So shared q-grams are
counted in diagonal bands of width ``2 (e + 1)`` that overlap by half; a band that reaches the bound is kept, and a banded
alignment of the whole passage against that region verifies the edits.

Texts and passages are compared as UTF-8 bytes with A-Z and the Latin-1 capitals lower-cased and white space (``\\x09-\\x0D``) read
as a space.
``e`` is ``error_rate`` times the passage length, lowered where needed so that the bound stays at one or more.

Defined cases: a NULL or empty text, or one shorter than ``q`` bytes, matches nothing; a NULL passage, or one shorter than
``min_bytes``, is not searched; equal passages are searched once each, under their own ids; a repeated row gives its matches
again; an empty table gives no match.

Scale: a benchmark of up to ``slice_bytes`` (measured) goes to every task, and the documents are read once, without a shuffle. A larger
one is dealt into slices of about that size by Spark; one slice after the other passes the driver, is searched for in a job that
writes what it found per text, and is released. Matches depend on the text alone, so they are kept once per distinct text and come back to
the documents by the text's SHA-256, with texts of very many copies salted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import lookup
from .common import discard, with_python_columns, written
from .text_arrays import CHUNK_BYTES, GOLDEN, U, Docs, chunks, distinct, tally

Q = 8
ERROR_RATE = 0.1
MIN_BYTES = 24
SLICE_BYTES = 4 << 20
LARGEST = 1 << 62    # of a cell's number times a place
_BITS = 21
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32

MATCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType())])

_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes in the form that is compared. Latin-1 capitals are C3 80 to C3 9E (but for C3 97) in UTF-8, their small letters
    20 (hexadecimal) further; the length stays."""
    out = _FOLD[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[second] += 0x20
    return out


def edit_budget(m: int, q: int, error_rate: float) -> int:
    return max(0, min(int(error_rate * m), (m - q) // q))


def _grams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number (zeros past the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy()


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * GOLDEN) >> U(64 - _BITS)).astype(np.int64)


class PassageIndex:
    """The q-grams of a slice of passages, with their passage and place."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, error_rate: float = ERROR_RATE):
        if not 1 <= q <= 8:
            raise ValueError("q must be 1 to 8")
        self.q, self.ids = q, [i for i, _ in items]
        self.text = [folded(np.frombuffer(x, np.uint8)) for _, x in items]
        m = np.array([len(x) for x in self.text], np.int64)
        self.edits = np.array([edit_budget(int(n), q, error_rate) for n in m], np.int64)
        self.least = m - q + 1 - q * self.edits
        self.mask = U(0xFFFFFFFFFFFFFFFF >> (64 - 8 * q))
        grams = [(_grams(x) & self.mask)[:len(x) - q + 1] for x in self.text]
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.first = np.unique(every[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(every)))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[_slot(self.gram)] = True

    def search(self, docs: Docs) -> list[tuple[int, int, int, int, int]]:
        """``(document, passage, start, end, edits)`` of the verified regions of a chunk, offsets within the document."""
        data = folded(docs.data)
        if len(data) < self.q or not len(self.gram):
            return []
        grams = _grams(data) & self.mask
        at = np.flatnonzero(self.seen[_slot(grams)])
        k = np.searchsorted(self.gram, grams[at])
        k[k == len(self.gram)] = 0
        real = self.gram[k] == grams[at]
        at, k = at[real], k[real]
        doc = np.searchsorted(docs.off, at, "right") - 1
        inside = at + self.q <= docs.off[doc + 1]
        at, k, doc = at[inside], k[inside], doc[inside]
        # one row per (document position, passage position) of a shared q-gram
        n = self.count[k]
        rows = np.repeat(np.arange(len(at)), n)
        entry = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(len(rows))
        item, width = self.item[entry], self.edits[self.item[entry]] + 1
        diagonal = at[rows] - docs.off[doc[rows]] - self.place[entry]
        band = diagonal // width
        shift = int(-band.min()) + 1 if len(band) else 0
        many = int(band.max()) + shift + 1 if len(band) else 1
        key = (doc[rows] * len(self.ids) + item) * many + band + shift
        longest = max(len(x) for x in self.text)
        cells = None
        if len(key) and int(key.max()) * longest >= LARGEST:    # cells are numbered anew where their product would not fit
            cells, key = np.unique(key, return_inverse=True)
        # a passage q-gram counts once in a cell, however often the document repeats it there
        found, total = tally(distinct(key * longest + self.place[entry]) // longest)
        found = found if cells is None else cells[found]
        # the overlapping band b spans the half-overlapping cells b and b + 1
        nxt = np.searchsorted(found, found + 1)
        same = nxt < len(found)
        same[same] = found[nxt[same]] == found[same] + 1
        both = total + np.where(same, total[np.where(same, nxt, 0)], 0)
        prev = np.searchsorted(found, found - 1)
        lone = ~((prev < len(found)) & (found[np.minimum(prev, len(found) - 1)] == found - 1)) if len(found) else same
        it = (found // many) % max(1, len(self.ids))
        keep = (both >= self.least[it]) & (lone | same | (total >= self.least[it]))
        out = []
        for f in found[keep]:
            b, di = int(f % many) - shift, int(f // many)
            d, i = divmod(di, len(self.ids))
            w = int(self.edits[i]) + 1
            got = align(self.text[i], data[docs.off[d]:docs.off[d + 1]], b * w, (b + 2) * w - 1, w - 1)
            if got:
                out.append((d, i, *got))
        return out

    def matches(self, column: pa.Array) -> list[list[dict]]:
        """For each text its distinct matches in document order; of overlapping ends of one region, the best."""
        out: list[list[dict]] = [[] for _ in range(len(column))]
        for docs in chunks(column, CHUNK_BYTES):
            best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            for d, i, start, end, edits in self.search(docs):
                best.setdefault((d, i), []).append((edits, start, end))
            for (d, i), regions in best.items():
                taken: list[tuple[int, int, int]] = []
                for edits, start, end in sorted(set(regions)):
                    if all(end <= s or start >= e for _, s, e in taken):
                        taken.append((edits, start, end))
                out[docs.lo + d] += [{"item_id": self.ids[i], "start": s, "end": e, "edits": x} for x, s, e in taken]
        for m in out:
            m.sort(key=lambda x: (x["start"], x["item_id"], x["end"]))
        return out


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole ``passage`` with a part of ``text`` inside the band of diagonals ``low .. high`` widened
    by the budget: ``(start, end, edits)``, or None beyond the budget. Ties: the earliest end, then the latest start."""
    m, n = len(passage), len(text)
    exact = text[max(0, low):max(0, high + m)].tobytes().find(passage.tobytes())
    if exact >= 0:                              # no edits on some diagonal: nothing can be better
        return max(0, low) + exact, max(0, low) + exact + m, 0
    low, high = low - budget, high + budget
    width = high - low + 1
    far = 1 << 20
    place = np.arange(width)
    column = place + low  # text position of each cell in row 0
    cost = np.where((column >= 0) & (column <= n), 0, far)
    origin = column.copy()
    padded = np.full(width + m, 256, np.int16)
    lo, hi = max(0, low), min(n, low + width + m)
    if hi > lo:
        padded[lo - low:hi - low] = text[lo:hi]
    for j in range(m):
        # cell x of row j + 1 is text position low + j + 1 + x; its diagonal predecessor is cell x of row j
        step = cost + (padded[j:j + width] != passage[j])
        start = origin
        up = np.append(cost[1:], far) + 1       # passage byte deleted
        better = up < step
        step = np.where(better, up, step)
        start = np.where(better, np.append(origin[1:], 0), start)
        run = step - place                      # text bytes inserted, left to right
        least = np.minimum.accumulate(run)
        src = np.maximum.accumulate(np.where(run == least, place, 0))
        cost, origin = least + place, start[src]
        column = place + low + j + 1
        cost = np.where((column >= 0) & (column <= n), np.minimum(cost, far), far)
        if cost.min() > budget:
            return None
    x = int(np.argmin(cost))
    if cost[x] > budget:
        return None
    return int(origin[x]), int(low + m + x), int(cost[x])


def _found(column: pa.Array, index: PassageIndex) -> pa.Array:
    return pa.array(index.matches(column), _ARROW)


def _passages(benchmark: DataFrame, id_column: str, text_column: str, min_bytes: int) -> DataFrame:
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    return rows.where(F.col("text").isNotNull() & (F.octet_length("text") >= min_bytes))


def _items(rows: DataFrame) -> list[tuple[int, bytes]]:
    """One slice; the caller has measured it."""
    return [(r["item_id"], r["text"].encode()) for r in rows.collect()]


def _searched(docs: DataFrame, text: str, items: list[tuple[int, bytes]], q: int, error_rate: float) -> DataFrame:
    """``sha, found``: the matches of one slice per distinct text that has any, as a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = PassageIndex(shared.value, q, error_rate)
        for batch in batches:
            found = _found(batch.column(0), index)
            at = np.flatnonzero(pc.list_value_length(found).to_numpy(zero_copy_only=False))
            sha = [hashlib.sha256(batch.column(0)[i].as_py().encode()).hexdigest() for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), found.take(pa.array(at))], names=["sha", "found"])

    schema = T.StructType([T.StructField("sha", T.StringType()), T.StructField("found", T.ArrayType(MATCH))])
    out = written(docs.select(text).mapInArrow(run, schema).dropDuplicates(["sha"]), "benchmark_slice")
    shared.destroy()            # the job that read it has ended, and what it found is written
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "item_id", passage: str = "text",
             q: int = Q, error_rate: float = ERROR_RATE, min_bytes: int = MIN_BYTES,
             slice_bytes: int = SLICE_BYTES, name: str = "matches") -> DataFrame:
    """``docs`` with array column ``name`` of ``(item_id, start, end, edits)``: byte spans near a benchmark passage, by start, item and end."""
    passages = _passages(benchmark, id_column, passage, max(q, min_bytes))
    total = passages.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= slice_bytes:
        shared = docs.sparkSession.sparkContext.broadcast(_items(passages))

        def make(column, built=[]):  # noqa: B006  the index is built once per Python worker and task
            if not built:
                built.append(PassageIndex(shared.value, q, error_rate))
            return [_found(column, built[0])]

        return with_python_columns(docs, text, [T.StructField(name, T.ArrayType(MATCH))], make)

    n = -(-total // slice_bytes)
    dealt = written(passages.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark")
    parts = [_searched(docs, text, _items(dealt.where(F.col("slice") == i).drop("slice")), q, error_rate) for i in range(n)]
    discard(dealt)
    # at most one row per slice and text
    by_place = F.array_sort(F.flatten(F.collect_list(F.transform("found", lambda m: F.struct(m["start"], m["item_id"], m["end"], m["edits"])))))
    every = reduce(DataFrame.unionByName, parts).groupBy("sha").agg(by_place.alias("found"))
    every = every.select("sha", F.transform("found", lambda m: F.struct(*[m[c].alias(c) for c in MATCH.names])).alias("found"))
    key = "sha"
    while key in docs.columns or key == name:
        key += "_"
    every = written(every.withColumnsRenamed({"sha": key, "found": name}), "benchmark_matches")
    discard(*parts)
    spread = "doc_id" if "doc_id" in docs.columns else text
    own = docs.drop(name).withColumn(key, F.sha2(F.col(text).cast("binary"), 256))
    out = lookup(own, every, key, spread, (name,)).withColumn(name, F.coalesce(name, F.array().cast(T.ArrayType(MATCH))))
    return out.select(*[c for c in docs.columns if c != name], name)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; columns and other rows stay as they are."""
    name = "__matches"
    return annotate(docs, benchmark, name=name, **options).where(F.size(name) == 0).select(*docs.columns)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: one row per document region near a benchmark passage."""
    found = annotate(docs.select("doc_id", "text"), benchmark, **options)
    return found.select("doc_id", F.inline("matches"))
