"""Counting 64-bit keys (n-grams, windows) over a whole corpus when every document needs the counts of its own keys.

A join of exploded keys would shuffle one row per key and occurrence, twice. Here documents are packed into blocks of
bounded bytes, and keys travel as sorted, compressed arrays:

1. ``pack``: each task packs its rows into blocks (Arrow IPC, zstd), written once to the shared folder;
2. ``count``: each block sends its distinct keys with their counts, cut by key range into buckets (one row per block and
   bucket); a bucket adds up the counts of all blocks and answers each block with the totals of the keys it sent, in the
   order it sent them; the answers are written, which cuts the lineage;
3. ``answered``: block and answers meet again by block number.

With ``n`` blocks and as many buckets there are up to ``n`` squared rows, so buckets are as many as blocks only up to ``FAN``. Beyond,
counting takes levels, like the digits of a number: a block sends ``fan`` rows, sets of ``fan`` blocks add up each bucket and
send the sums on, cut ``fan`` times finer, and so forth; the totals come down the same way. Each level is one more written copy of the
requests, each group holds about as many keys as a block at every level, and a block has at most ``FAN`` rows a level: with two
levels up to 16.7 million blocks.

A hot key is one entry per block, so no bucket gets more than its share; blocks and buckets are bounded, and nothing
reaches the driver but the number of blocks. Lost executors: every step reads a written table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, written

BLOCK_BYTES = 8 << 20
FAN = 4096
_REQUEST = "kind int, bucket int, block long, keys binary, counts binary"
_ANSWER = "block long, kind int, bucket int, totals binary, n_distinct long, n_total long"


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values, byte planes apart (high planes of small or sorted values compress to nothing)."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(expand(raw), dtype=np.uint64)


class Blocks(NamedTuple):
    """A written table ``(block, payload)``, how many blocks it has and the schema of the packed rows."""

    table: DataFrame
    n: int
    schema: T.StructType


def _bytes_of(batch: pa.RecordBatch) -> np.ndarray:
    """A cheap upper estimate of each row's bytes: its string lengths and a few bytes for the rest."""
    size = np.full(batch.num_rows, 16, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            size += pa.compute.fill_null(pa.compute.binary_length(c), 0).to_numpy(zero_copy_only=False)
    return size


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """The rows of ``docs`` in blocks of about ``block_bytes`` (a longer row is a block of its own)."""
    def seal(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for p in parts:
                out.write_batch(p)
        task = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays([pa.array([(task << 32) + number], pa.int64()),
                                           pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, have, number = [], 0, 0
        for batch in batches:
            ends = np.cumsum(_bytes_of(batch))
            lo = 0
            while lo < batch.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + (not parts), int(np.searchsorted(ends, before + block_bytes - have, "right")))
                if hi > lo:
                    parts.append(batch.slice(lo, hi - lo))
                    have += int(ends[hi - 1]) - before
                if hi < batch.num_rows:
                    yield seal(parts, number)
                    parts, have, number = [], 0, number + 1
                lo = hi
        if parts:
            yield seal(parts, number)

    table = written(docs.mapInArrow(run, "block long, payload binary"), "blocks")
    return Blocks(table, table.count(), docs.schema)


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


#: From the rows of a block and the totals of each kind of key counted before, the sorted distinct keys and counts by kind.
Ask = Callable[[pa.Table, dict[int, np.ndarray]], dict[int, tuple[np.ndarray, np.ndarray]]]


class Answers(NamedTuple):
    table: DataFrame


def _totals(answers: pa.Table) -> dict[int, np.ndarray]:
    """By kind the totals in key order: those of the buckets one after the other."""
    rows = sorted(zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist(), answers["totals"].to_pylist(), strict=True),
                  key=lambda r: r[:2])
    out: dict[int, list[np.ndarray]] = {}
    for kind, _, raw in rows:
        out.setdefault(kind, []).append(expand(raw))
    return {k: np.concatenate(v) for k, v in out.items()}


def _cut(block: int, asked: dict[int, tuple[np.ndarray, np.ndarray]], n_buckets: int, own: range) -> pa.RecordBatch:
    """Requests of one block or set, a row per kind and bucket: all its keys lie in the buckets ``own`` of ``n_buckets``."""
    edges = np.array([(i << 64) // n_buckets for i in own[1:]], dtype=np.uint64)
    rows = []
    for kind, (keys, counts) in asked.items():
        cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        rows += [(kind, b, block, squeeze_sorted(keys[lo:hi]), squeeze(counts[lo:hi].astype(np.uint64)))
                 for b, lo, hi in zip(own, cut[:-1], cut[1:], strict=True) if hi > lo]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                      names=["kind", "bucket", "block", "keys", "counts"])


def _summed(asked: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each request; the distinct keys of all, their totals, and for each key of each request its place among the distinct."""
    keys = [expand_sorted(x) for x in asked["keys"].to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.flatnonzero(first)
    counts = np.concatenate([expand(x) for x in asked["counts"].to_pylist()])[order]
    place = np.empty(len(every), np.int64)
    place[order] = np.cumsum(first) - 1
    return keys, ranked[at], np.add.reduceat(counts, at), place


def _answers(asked: pa.Table, keys: list[np.ndarray], back: np.ndarray, n_distinct: int, n_total: int) -> pa.Table:
    """``back``: the total of each key of each request, one after the other."""
    n = len(keys)
    cut = np.cumsum([0, *map(len, keys)])
    return pa.table({
        "block": asked["block"], "kind": asked["kind"], "bucket": asked["bucket"],
        "totals": pa.array([squeeze(back[cut[i]:cut[i + 1]]) for i in range(n)], pa.binary()),
        "n_distinct": pa.array([n_distinct] + [0] * (n - 1), pa.int64()), "n_total": pa.array([n_total] + [0] * (n - 1), pa.int64())})


def _add_up(asked: pa.Table) -> pa.Table:
    """All requests of one kind and bucket: the totals of each request's keys."""
    keys, _, total, place = _summed(asked)
    return _answers(asked, keys, total[place], int((total > 0).sum()), int(total.sum()))


def levels(n_blocks: int, most: int = FAN) -> tuple[int, int]:
    """How many levels there are, and the buckets of a block on each: the least that reaches all blocks, at most ``most``."""
    n, fan = 1, 1
    while most ** n < n_blocks:
        n += 1
    while fan ** n < n_blocks:
        fan += 1
    return n, fan


def _totalled(asked: DataFrame, nodes: int, n_levels: int, fan: int, ranges: int) -> tuple[DataFrame, list[DataFrame]]:
    """The answers to the requests of ``nodes`` blocks or sets, whose buckets cut the keys into ``ranges``; and the written tables they read."""
    if n_levels == 1:
        return asked.groupBy("kind", "bucket").applyInArrow(_add_up, _ANSWER), []
    asked = written(asked, "requests")
    sets = -(-nodes // fan)
    dealt = asked.withColumn("set", F.pmod(F.xxhash64("block"), F.lit(sets)).cast("long"))

    def merge(rows: pa.Table) -> pa.Table:
        _, keys, total, _ = _summed(rows)
        kind, bucket, owner = (rows[c][0].as_py() for c in ("kind", "bucket", "set"))
        return pa.Table.from_batches([_cut(owner, {kind: (keys, total)}, ranges * fan, range(bucket * fan, (bucket + 1) * fan))])

    above, read = _totalled(dealt.groupBy("set", "kind", "bucket").applyInArrow(merge, _REQUEST), sets, n_levels - 1, fan, ranges * fan)

    def down(rows: pa.Table, sums: pa.Table) -> pa.Table:
        keys, _, _, place = _summed(rows)
        ordered = sorted(zip(sums["fine"].to_pylist(), sums["totals"].to_pylist(), strict=True))
        total = np.concatenate([expand(raw) for _, raw in ordered])
        return _answers(rows, keys, total[place], pa.compute.sum(sums["n_distinct"]).as_py(), pa.compute.sum(sums["n_total"]).as_py())

    above = above.select(F.col("block").alias("set"), "kind", F.col("bucket").alias("fine"),
                         F.floor(F.col("bucket") / F.lit(fan)).cast("int").alias("bucket"), "totals", "n_distinct", "n_total")
    key = ["set", "kind", "bucket"]
    return dealt.groupBy(*key).cogroup(above.groupBy(*key)).applyInArrow(down, _ANSWER), [asked, *read]


def count(blocks: Blocks, ask: Ask, after: Answers | None = None, name: str = "answers", most: int | None = None) -> Answers:
    """One round of counting; with ``after``, ``ask`` also gets the totals of that earlier round. ``most``: in place of ``FAN``."""
    n_levels, fan = levels(blocks.n, most or FAN)

    def requests(block: int, asked: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return _cut(block, asked, fan, range(fan))

    if after is None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, payload in zip(batch["block"].to_pylist(), batch["payload"].to_pylist(), strict=True):
                    yield requests(block, ask(unpack(payload), {}))

        asked = blocks.table.mapInArrow(run, _REQUEST)
    else:
        asked = answered(blocks, after, lambda rows, totals, block: pa.Table.from_batches([requests(block, ask(rows, totals))]), _REQUEST)
    totals, read = _totalled(asked, blocks.n, n_levels, fan, fan)
    out = written(totals, name)
    discard(*read)
    return Answers(out)


def merged(first: Answers, second: Answers) -> Answers:
    return Answers(first.table.unionByName(second.table))


def answered(blocks: Blocks, answers: Answers, fn: Callable[[pa.Table, dict[int, np.ndarray], int], pa.Table],
             schema: str | T.StructType) -> DataFrame:
    """``fn(rows, totals by kind, block number)`` for each block, with its answers beside it."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(unpack(left["payload"][0].as_py()), _totals(right), left["block"][0].as_py())

    own = answers.table.select("block", "kind", "bucket", "totals")
    return blocks.table.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(run, schema)


def stats(answers: Answers, kind: int) -> tuple[int, int]:
    """How many distinct keys of a kind were counted (above 0), and their counts added up."""
    row = answers.table.where(F.col("kind") == kind).agg(F.sum("n_distinct"), F.sum("n_total")).first()
    return int(row[0] or 0), int(row[1] or 0)
