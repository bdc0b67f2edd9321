"""Conversation prefix tries: double arrays per range of paths, shared upper nodes merged over all ranges.

A path is a sequence of turns, each 24 bytes: 16 bytes of the SHA-256 of role and text and the text's byte count. Conversations
are range-partitioned and sorted by path and id, so the members of any node stand together, a hot first turn or a
hot whole conversation spreads over as many tasks as its rows need, and only the prefixes of a range's first and last path can
reach into another range. In each range (a prefix shard):

1. turns get dense ids; BASE and CHECK are packed level by level over them (``DoubleArray``): parents with one child take the
   next free slots, the others the first free place that fits all their children;
2. every distinct path is walked through the arrays, which counts members and finds the least one of each node;
3. sums over subtrees run bottom-up. Nodes off the first and last path are final here. The open ones leave with what their closed
   children add up to, and the ids that end at them in ascending pieces.

Open nodes are merged by key (partial aggregation), rolled up in one task and joined back as the parents of closed ones: there
are at most twice as many as ranges times turns of a path. The pieces of ids are hashed in order, one after the other.

Bounds: a task holds its range's paths (24 bytes a turn, ``RANGE_BYTES`` on average) and the tables of its nodes; a conversation's own
turns travel as one array without texts. Steps read written tables, so lost executors repeat tasks only.

Defined cases: NULL turns come first, ties go by the hash of role and text; a NULL role or text is empty; a repeated row is one more
turn; rows without a conv_id take no part; a conversation with nothing left ends at the root; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from .common import written

TURN = 24                  # bytes of a turn in a path
RANGE_BYTES = 16 << 20
PIECE = 1 << 16            # ids in a piece of an open node's ends
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
CLOSED, OPEN, ENDS = 0, 1, 2
_PARTS = ("kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, bytes long, ends string")
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_code() -> Column:
    """The hexadecimal form of a turn's 24 bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.octet_length(text)), 16, "0"))


def rebuilt(conversations: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """``conv_id, path``: the first h turns of conversation ``c - c % group``, then c's own after its first h, with
    h = crc32(c) % ``heads``. One shuffle by group: both sides of the join share it."""
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long"), F.struct(F.col("turn"), turn_code().alias("code")).alias("t"))
            .withColumn("first", F.col("conv_id") - F.col("conv_id") % group))
    own = rows.repartition("first").groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    own = own.select("first", "conv_id", F.transform("turns", lambda t: t["code"]).alias("turns"))
    lead = own.where(F.col("conv_id") == F.col("first")).select("first", F.col("turns").alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    path = F.concat(F.slice(F.coalesce("lead", F.array().cast("array<string>")), F.lit(1), h),
                    F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return own.join(lead, "first", "left").select("conv_id", F.unhex(F.array_join(path, "")).alias("path"))


class DoubleArray:
    """BASE and CHECK: the child of state s by code c is slot BASE[s] + c if CHECK there is s. State 0 is the root."""

    def __init__(self, n_codes: int):
        self.low = n_codes + 1                                   # so that every BASE is positive
        self.base = np.zeros(2 * self.low + 64, np.int64)
        self.check = np.full(2 * self.low + 64, -1, np.int64)
        self.end = self.low                                      # no slot from here on is taken

    def _room(self, upto: int) -> None:
        if upto >= len(self.check):
            more = max(upto + 1 - len(self.check), len(self.check))
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def chains(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Places one child for each parent in the next free slots."""
        n = len(parents)
        holes = np.flatnonzero(self.check[self.low:self.end] < 0)[:n] + self.low
        slots = np.concatenate([holes, np.arange(self.end, self.end + n - len(holes))])
        self._room(int(slots[-1]))
        self.base[parents], self.check[slots] = slots - codes, parents
        self.low = int(slots[-1]) + 1
        self.end = max(self.end, self.low)
        return slots

    def fork(self, parent: int, codes: np.ndarray, window: int = 4096) -> np.ndarray:
        """Places several children at the first free place that fits them all."""
        gaps = codes - codes.min()
        self._room(self.end + int(gaps.max()) + window)
        room = np.flatnonzero(self.check[self.low:self.end + 1] < 0)[:window] + self.low
        for g in gaps:
            room = room[self.check[room + g] < 0]
            if not len(room):
                break
        slots = (int(room[0]) if len(room) else self.end) + gaps
        self.base[parent], self.check[slots] = int(slots[0] - codes[0]), parent
        self.end = max(self.end, int(slots.max()) + 1)
        return slots


def pack(codes: np.ndarray, off: np.ndarray, n_codes: int) -> DoubleArray:
    """The double array of paths that stand in an order that keeps equal prefixes together; path i is ``codes[off[i]:off[i + 1]]``."""
    trie = DoubleArray(n_codes)
    size, state = np.diff(off), np.zeros(len(off) - 1, np.int64)
    live = np.flatnonzero(size > 0)
    depth = 0
    while len(live):
        parent, code = state[live], codes[off[live] + depth]
        new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])])
        first = np.flatnonzero(new)
        parents, labels = parent[first], code[first]
        lead = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        n = np.diff(np.append(lead, len(parents)))
        slots = np.empty(len(parents), np.int64)
        for i in np.flatnonzero(n > 1):
            part = slice(lead[i], lead[i] + n[i])
            slots[part] = trie.fork(int(parents[lead[i]]), labels[part])
        alone = lead[n == 1]
        if len(alone):
            slots[alone] = trie.chains(parents[alone], labels[alone])
        state[live] = slots[np.cumsum(new) - 1]
        depth += 1
        live = live[size[live] > depth]
    return trie


def walk(trie: DoubleArray, codes: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(depth, paths, states)`` level by level: where the paths that reach a depth stand in the double array."""
    size, state = np.diff(off), np.zeros(len(off) - 1, np.int64)
    live = np.arange(len(size))
    depth = 0
    while len(live):
        yield depth, live, state[live]
        live = live[size[live] > depth]
        nxt = trie.base[state[live]] + codes[off[live] + depth]
        if (trie.check[nxt] != state[live]).any():
            raise AssertionError("a path left its trie")
        state[live] = nxt
        depth += 1


def _trail(path: bytes) -> list[bytes]:
    """Keys of a path's prefixes, the root first."""
    keys = [ROOT]
    for i in range(0, len(path), TURN):
        keys.append(hashlib.sha256(keys[-1] + path[i:i + TURN]).digest()[:16])
    return keys


def _shard(paths: list[bytes], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes of one range, rows sorted by path and id."""
    first = [0] + [i for i in range(1, len(paths)) if paths[i] != paths[i - 1]]
    bounds = np.append(first, len(paths))
    own = [paths[i] for i in first]
    off = np.concatenate([[0], np.cumsum([len(x) // TURN for x in own])])
    turns = pa.Array.from_buffers(pa.binary(TURN), int(off[-1]), [None, pa.py_buffer(b"".join(own))]).dictionary_encode()
    codes = turns.indices.to_numpy().astype(np.int64) + 1
    weight = np.array([0] + [int.from_bytes(x[16:], "big") for x in turns.dictionary.to_pylist()], np.int64)
    trie = pack(codes, off, len(weight))

    n_slots = len(trie.check)
    n, depth, size = (np.zeros(n_slots, np.int64) for _ in range(3))
    least = np.full(n_slots, np.iinfo(np.int64).max)
    last = np.zeros(len(own), np.int64)
    trails: tuple[list[int], list[int]] = ([], [])               # states of the first and of the last path
    for d, live, state in walk(trie, codes, off):
        np.add.at(n, state, np.diff(bounds)[live])
        np.minimum.at(least, state, ids[bounds[live]])
        depth[state], last[live] = d, state
        if d:
            size[state] = weight[codes[off[live] + d - 1]]
        for trail, i, at in ((trails[0], 0, 0), (trails[1], len(own) - 1, -1)):
            if live[at] == i:
                trail.append(int(state[at]))
    keys = {s: k for trail, p in zip(trails, (own[0], own[-1]), strict=True) for s, k in zip(trail, _trail(p), strict=True)}
    opened = np.zeros(n_slots, bool)
    opened[list(keys)] = True

    nodes = np.append(0, np.flatnonzero(trie.check >= 0))
    parent = trie.check
    n_children = np.bincount(parent[nodes[1:]], minlength=n_slots)
    leaves = ((n_children == 0) & (n > 0) & ~opened).astype(np.int64)
    saved = np.where(opened, 0, (n - 1) * size)
    closed = nodes[~opened[nodes]]
    closed = closed[np.argsort(-depth[closed], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[closed])) + 1
    for level in np.split(closed, cuts):                         # deepest first
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    closed_children = np.bincount(parent[closed], minlength=n_slots)

    ends = dict(zip(last.tolist(), range(len(own)), strict=True))
    text = lambda i: ",".join(map(str, ids[bounds[i]:bounds[i + 1]].tolist()))

    def batch(kind: int, **columns) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        schema = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.split()[1]])
                            for f in _PARTS.split(", ")])
        columns["kind"] = [kind] * rows
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema],
                                          schema=schema)

    for i in range(0, len(closed), 1 << 16):
        part = closed[i:i + (1 << 16)]
        up = parent[part]
        yield batch(CLOSED, parent_key=[keys.get(s) for s in up.tolist()], conv_id=least[part], depth=depth[part],
                    parent_conv_id=pa.array(least[up], mask=opened[up]), n_convs=n[part], n_children=n_children[part], n_leaves=leaves[part],
                    saved_tokens=saved[part], ends=[hashlib.sha256(text(ends[s]).encode()).hexdigest() if s in ends else NO_ENDS
                                                    for s in part.tolist()])
    states = np.array(list(keys), np.int64)
    yield batch(OPEN, key=list(keys.values()), parent_key=[keys[int(parent[s])] if s else None for s in states.tolist()], conv_id=least[states],
                depth=depth[states], n_convs=n[states], n_children=closed_children[states], n_leaves=leaves[states], saved_tokens=saved[states],
                bytes=size[states])
    for s in states.tolist():
        if s in ends:
            lo, hi = bounds[ends[s]], bounds[ends[s] + 1]
            for at in range(lo, hi, PIECE):
                piece = ids[at:min(hi, at + PIECE)].tolist()
                yield batch(ENDS, key=[keys[s]], conv_id=[piece[0]], ends=[",".join(map(str, piece))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths: list[bytes] = []
    ids: list[np.ndarray] = []
    for b in batches:
        paths += b.column(0).to_pylist()
        ids.append(b.column(1).to_numpy())
    if paths:
        yield from _shard(paths, np.concatenate(ids))


def _rolled_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The merged open nodes, with their subtrees' sums and their parents' least members."""
    parts = list(batches)
    if not sum(b.num_rows for b in parts):
        return
    t = pa.Table.from_batches(parts).sort_by([("depth", "descending")])
    key, up, conv, depth, n, children, leaves, saved, size = (t.column(c).to_pylist() for c in (
        "key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes"))
    place = {k: i for i, k in enumerate(key)}
    for i, k in enumerate(up):                                   # deepest first: a node's children came before it
        leaves[i] += children[i] == 0
        saved[i] += (n[i] - 1) * size[i]
        if k is not None:
            j = place[k]
            children[j] += 1
            leaves[j] += leaves[i]
            saved[j] += saved[i]
    over = [None if k is None else conv[place[k]] for k in up]
    yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary())] + [pa.array(x, pa.int64()) for x in (
        conv, depth, over, n, children, leaves, saved)], names=["key", *_NODE[:-1]])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's pieces, which come in order; nothing but the running hash is held."""
    key, run = None, None
    done: list[tuple[bytes, str]] = []
    for b in batches:
        for k, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k == key:
                run.update(b",")
            else:
                if key is not None:
                    done.append((key, run.hexdigest()))
                key, run = k, hashlib.sha256()
            run.update(piece.encode())
    if key is not None:
        done.append((key, run.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                                     names=["key", "ends"])


def nodes(paths: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per node of the trie of ``paths (conv_id, path)``: see ``_NODE``."""
    spark = paths.sparkSession
    paths = written(paths.select("path", "conv_id"), "trie_paths")
    total = paths.agg(F.sum(F.length("path"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    dealt = paths.repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(dealt.mapInArrow(_shards, _PARTS), "trie_parts")

    merged = parts.where(F.col("kind") == OPEN).groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.first("bytes").alias("bytes"))
    upper = written(merged.coalesce(1).mapInArrow(_rolled_up, "key binary, " + ", ".join(f"{c} long" for c in _NODE[:-1])), "trie_upper")
    pieces = parts.where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
    hashed = (pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(_ends, "key binary, ends string"))
    shared = upper.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).select(*_NODE)

    over = sized_broadcast(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("over")))
    closed = (parts.where(F.col("kind") == CLOSED).join(over, "parent_key", "left")
              .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over")).withColumn("ends_sha256", F.col("ends")).select(*_NODE))
    return shared.unionByName(closed)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of all rebuilt conversations."""
    return nodes(rebuilt(conversations))
