"""Boosted regression trees for all horizons at once (M3): one binned table, trees grown by level, small nodes finished in one task.

Loss, penalty and limits are those of the method: squared loss from a constant start, the gain of a split
``GL^2 / (nL + l2) + GR^2 / (nR + l2) - G^2 / (n + l2)`` has to reach ``min_split_loss``, leaves weigh ``-G / (n + l2)`` times the
step. Each tree sees a part of the rows (hash of the row key) and of the features (hash of the feature).

* Cuts of the features come from one aggregation over the feature table; rows carry their 93 bins as bytes.
* A horizon of up to ``group_rows`` rows is boosted ``chunk_rounds`` rounds at a time in one task per horizon (``chunk``). A node costs
  its bins and the rows of the smaller children, whatever the number of levels. Rows are added up in steps that stay in a core's cache,
  large nodes by pairs of features that have few bins.
* A larger one is grown level by level over all its partitions: each task sums the gradients of its rows per open node, feature and
  bin, the sums meet per node, and only the chosen splits reach the driver. As soon as a node has up to ``group_rows`` rows, its
  subtree is finished in one task (``finish``).
* Rows and their predictions are written after every chunk (or round), which cuts lineage and lets a stopped run go on.

Gradients are integers (units of 2^-16), so sums do not depend on the order or the number of partitions, and neither does the model.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import GbtParams, Params
from .training import horizon_filter

UNIT = 1 << 16
ROW, NODE = 0, 1
STATE = ("kind int, horizon int, key long, bins binary, y double, pred double, tree int, node int, feature int, bin int, cut double, "
         "value double")
_TYPES = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in STATE.split(", ")])
_CELLS = 1 << 15           # rows times features, or nodes times bins, that a step looks at together
_BLOCK = 1 << 14           # rows times features that are added up at a time, at least
_PAIRED = 512              # bins of one feature times bins of another, to add up both at once
_ALONE = 512               # rows of a node, on average, from which on each one's rows are divided by themselves
_LARGE = 1024              # rows of a node that is added up by pairs of features, at least
_SORTED = 8                # a node is split by sorted rows if that many times its rows and features are fewer than the bins


def _mix(x) -> np.ndarray:
    """The splitmix64 finaliser of 64-bit values (wraps around on purpose)."""
    x = np.asarray(x).astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(g: GbtParams, horizon: int, tree: int) -> np.uint64:
    return _mix(_mix(g.seed + 1) ^ np.uint64((horizon << 32) + tree + 1))


def sampled(key: np.ndarray, g: GbtParams, horizon: int, tree: int) -> np.ndarray:
    """Which rows a tree grows on."""
    return (_mix(key.astype(np.int64).view(np.uint64) ^ _salt(g, horizon, tree)) >> np.uint64(11)) < np.uint64(int(g.subsampling_rate * (1 << 53)))


def chosen(n_features: int, g: GbtParams, horizon: int, tree: int) -> np.ndarray:
    """Which features a tree may split on, ascending."""
    rank = np.argsort(_mix(np.arange(n_features).astype(np.uint64) ^ _mix(_salt(g, horizon, tree) ^ np.uint64(1 << 63))), kind="stable")
    return np.sort(rank[:max(1, int(g.feature_fraction * n_features))])


def gradients(pred: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.rint((pred - y) * UNIT).astype(np.int64)


# ---- the binned table ----------------------------------------------------------------------------------------------------

def feature_cuts(table: DataFrame, g: GbtParams) -> list[list[float]]:
    """Ascending distinct cut values of each feature: quantiles over the whole table, in one aggregation by feature."""
    shares = [i / g.max_bins for i in range(1, g.max_bins)]
    found = (table.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
             .groupBy("feature").agg(F.percentile_approx("x", shares, 10_000).alias("cuts")).collect())
    return [sorted(set(r["cuts"])) for r in sorted(found, key=lambda r: r["feature"])]


def binned_rows(table: DataFrame, cuts: list[list[float]], p: Params) -> DataFrame:
    """The start of the training state: a row per horizon and feature row with a positive label; ``bins`` has a byte per feature, the
    number of cuts below its value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            bins = np.stack([np.searchsorted(np.array(c), x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in bins], pa.binary())],
                                             names=["key", "labels", "bins"])

    wanted = F.array(*[F.when(horizon_filter(h, p), F.col("labels")[h].cast("double")) for h in range(p.fr_len)])
    rows = table.select(F.xxhash64("sta_num", "pre_end").alias("key"), wanted.alias("labels"), vector_to_array("features").alias("x"))
    made = rows.mapInArrow(run, "key long, labels array<double>, bins binary")
    long = made.select("key", "bins", F.posexplode("labels").alias("horizon", "y")).where(F.col("y").isNotNull())
    none = {f.split()[0]: F.lit(None).cast(f.split()[1]) for f in STATE.split(", ")}
    have = none | {"kind": F.lit(ROW), "horizon": F.col("horizon"), "key": F.col("key"), "bins": F.col("bins"), "y": F.col("y"),
                   "pred": F.lit(p.gbt.base_score)}
    return long.select(*[c.alias(n) for n, c in have.items()])


# ---- growing a tree over the rows of one task ----------------------------------------------------------------------------------

class Nodes(NamedTuple):
    """Nodes of one tree: heap ids (children of i: 2i and 2i + 1), feature (-1 for a leaf), bin and value of each."""

    node: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray


def leaf(total, n, g: GbtParams):
    return -(total / UNIT) / (n + g.l2) * g.step_size


def _gain(gl, nl, total, n, g: GbtParams):
    left, right = gl / UNIT, (total - gl) / UNIT
    return left * left / (nl + g.l2) + right * right / (n - nl + g.l2)


def _best(bins: np.ndarray, order: np.ndarray, grad: np.ndarray, starts: np.ndarray, total: np.ndarray, feats: np.ndarray, g: GbtParams):
    """The best split of each segment: its gain before the parent's share, feature and bin (the least of equal ones)."""
    m = order.shape[1]
    size = np.diff(np.append(starts, m))
    spread = lambda x: np.repeat(x, size, axis=-1)
    nl = np.arange(m) - spread(starts) + 1
    n, tot = spread(size), spread(total)
    fits = (nl >= g.min_instances_per_node) & (n - nl >= g.min_instances_per_node)
    best, feature, at = np.full(len(starts), -np.inf), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    step = max(4, _CELLS // m)
    for lo in range(0, len(feats), step):
        o = order[lo:lo + step]
        own = grad[o]
        run = np.cumsum(own, axis=1)
        gl = run - spread(run[:, starts] - own[:, starts])
        b = bins[o, feats[lo:lo + step, None]]
        ok = np.zeros(o.shape, bool)
        ok[:, :-1] = (b[:, :-1] != b[:, 1:]) & fits[:-1]
        gain = np.where(ok, _gain(gl, nl, tot, n, g), -np.inf)
        top = np.maximum.reduceat(gain, starts, axis=1)
        f = top.argmax(axis=0)
        t = top[f, np.arange(len(starts))]
        better = t > best
        hit = gain[spread(f), np.arange(m)] == spread(t)
        first = np.minimum.reduceat(np.where(hit, np.arange(m), m - 1), starts)
        best, feature = np.where(better, t, best), np.where(better, feats[lo + f], feature)
        at = np.where(better, b[f, first], at)
    return best, feature, at


class _Pairs:
    """Two features of few bins as one feature of all pairs of their bins: a row is added up once for both, and each feature's sums are those
    over the other's bins. Wide features stand alone."""

    def __init__(self, bins: np.ndarray, width: np.ndarray):
        order, couples = np.argsort(width, kind="stable").tolist(), []
        while order:
            f = order.pop(0)
            couples.append((f, order.pop(0) if order and width[f] * width[order[0]] <= _PAIRED else -1))
        self.count = len(couples)
        size = [(int(width[f]), int(width[s]) if s >= 0 else 1) for f, s in couples]
        first = np.cumsum([0] + [a * b for a, b in size])
        self.n = int(first[-1])
        kind = np.uint16 if self.n < 1 << 16 else np.uint32
        self.cells = np.empty((len(bins), self.count), kind)
        for i, ((f, s), (_, b)) in enumerate(zip(couples, size, strict=True)):
            self.cells[:, i] = bins[:, f].astype(np.int64) * b + (bins[:, s] if s >= 0 else 0) + first[i]
        self.turned = np.concatenate([o + np.arange(a * b).reshape(a, b).T.ravel() for o, (a, b) in zip(first[:-1], size, strict=True)])
        self.starts = [np.concatenate([o + np.arange(n) * m for o, (n, m) in zip(first[:-1], x, strict=True)])
                       for x in (size, [(b, a) for a, b in size])]
        at = np.cumsum([0] + [a for a, _ in size] + [b for _, b in size]).tolist()
        self.place = np.zeros(len(width), np.int64)
        for (f, s), a, b in zip(couples, at, at[self.count:], strict=False):
            self.place[f] = a
            if s >= 0:
                self.place[s] = b

    def single(self, sums: np.ndarray) -> np.ndarray:
        """The sums of each feature's bins, a feature from its ``place`` on."""
        return np.concatenate([np.add.reduceat(sums, self.starts[0], axis=-1), np.add.reduceat(sums[..., self.turned], self.starts[1], axis=-1)], axis=-1)


class _Table:
    """What all trees of the same rows share: their bins row by row and feature by feature, pairs of features where that saves a quarter or
    more, and memory that every tree uses again."""

    def __init__(self, bins: np.ndarray):
        self.bins = bins
        self.columns = np.ascontiguousarray(bins.T)
        self.width = bins.max(axis=0).astype(np.int64) + 1
        self.kept: dict[tuple, np.ndarray] = {}
        # once a block of this size was given back, the allocator keeps smaller ones instead of fetching them anew, page by page
        np.empty(1 << 24, np.uint8)

    @functools.cached_property
    def pairs(self) -> _Pairs | None:
        narrow = np.sort(self.width)
        saves = sum(a * b <= _PAIRED for a, b in zip(narrow[::2], narrow[1::2], strict=False))
        return _Pairs(self.bins, self.width) if 4 * saves >= len(narrow) else None

    def memory(self, shape: tuple[int, int], kind) -> np.ndarray:
        if (shape[1], kind) not in self.kept or len(self.kept[shape[1], kind]) < shape[0]:
            self.kept[shape[1], kind] = np.empty(shape, kind)
        return self.kept[shape[1], kind]


def by_bin(bins: np.ndarray) -> _Table:
    """What ``grow`` needs of the rows, once for all their trees."""
    return _Table(bins)


def _by_sorting(bins: np.ndarray, grad: np.ndarray, feats: np.ndarray, g: GbtParams, ids: np.ndarray, seg: np.ndarray) -> tuple[Nodes, np.ndarray]:
    """The subtrees under the nodes ``ids`` by sorted rows, level by level, and the value of each row; ``seg`` is each row's place in ``ids``."""
    out: list[Nodes] = []
    value = np.zeros(len(grad))
    order = np.argsort(bins[:, feats], axis=0, kind="stable").T
    while True:
        move = np.argsort(seg[order].astype(np.int16 if len(ids) < 1 << 15 else np.int32), axis=1, kind="stable")
        order = np.take_along_axis(order, move, axis=1)
        size = np.bincount(seg[order[0]], minlength=len(ids))
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        total = np.add.reduceat(grad[order[0]], starts)
        best, feature, at = _best(bins, order, grad, starts, total, feats, g)
        splits = _gains_enough(best, total, size, g) & (ids < 1 << g.max_depth)
        weight = leaf(total, size, g)
        out.append(Nodes(ids, np.where(splits, feature, -1), np.where(splits, at, 0), np.where(splits, 0.0, weight)))
        done = (seg >= 0) & ~splits[seg]
        value[done], seg[done] = weight[seg[done]], -1
        if not splits.any():
            return Nodes(*[np.concatenate(x) for x in zip(*out, strict=True)]), value
        live = np.flatnonzero(seg >= 0)
        right = bins[live, feature[seg[live]]] > at[seg[live]]
        seg[live] = 2 * (np.cumsum(splits) - 1)[seg[live]] + right
        ids = (2 * ids[splits][:, None] + np.arange(2)).ravel()
        order = order[seg[order] >= 0].reshape(len(feats), -1)


def _gains_enough(best: np.ndarray, total: np.ndarray, size: np.ndarray, g: GbtParams) -> np.ndarray:
    whole = total / UNIT
    return best - whole * whole / (size + g.l2) >= max(g.min_split_loss, 1e-6)


class _Sums:
    """Gradients and rows per node, feature and bin of one tree: each feature has as many cells as it has bins. A cell counts from the
    total of the feature before it, so that one running sum over all cells gives the left sides of every feature's splits.

    Sums are whole numbers in doubles, exact up to 2^53. Rows and gradients share a double for as many rows as both fit (``together``).
    Rows are added up a block at a time, in memory that stays."""

    def __init__(self, table: _Table, grad: np.ndarray, used: np.ndarray, feats: np.ndarray):
        self.width = table.width[feats]
        self.first = np.cumsum(self.width) - self.width
        self.n = int(self.width.sum())
        self.feature = np.repeat(feats, self.width)
        self.bin = np.arange(self.n) - np.repeat(self.first, self.width)
        self.table, self.feats = table, feats
        size = np.abs(grad[used])
        self.exact = float(size.sum(dtype=np.float64)) < 1 << 52
        most = float(size.max(initial=1))
        self.together = int((2 ** 49 / most) ** 0.5)
        self.unit = float(1 << int(2 * self.together * most).bit_length())
        self.grad = grad.astype(np.float64)
        self.both = self.grad + self.unit

    def _added(self, weight: np.ndarray | None, rows: np.ndarray, seg: np.ndarray | None, k: int, pairs: _Pairs | None = None) -> np.ndarray:
        """The weights (or the number) of the rows per node and cell."""
        n, m = (pairs.n, pairs.count) if pairs else (self.n, len(self.feats))
        step = max(1, max(_BLOCK, k * n) // m)
        own, cells, spread = (self.table.memory((max(_BLOCK, _CELLS, k * n) // m + 1, m), x) for x in (np.uint8, np.int64, np.float64))
        out = np.zeros(k * n)
        for lo in range(0, len(rows), step):
            r = rows[lo:lo + step]
            at = cells[:len(r)]
            if pairs:
                at[:] = pairs.cells[r]
            else:
                at[:] = np.take(self.table.bins[r], self.feats, axis=1, out=own[:len(r)], mode="clip")
                at += self.first
            if k > 1:
                at += (seg[lo:lo + step] * n)[:, None]
            if weight is None:
                out += np.bincount(at.ravel(), minlength=len(out))
            else:
                spread[:len(r)] = weight[r][:, None]
                out += np.bincount(at.ravel(), spread[:len(r)].ravel(), len(out))
        return out.reshape(k, n)

    def of(self, rows: np.ndarray, size: np.ndarray, packed: bool) -> np.ndarray:
        """The sums of nodes over their rows, ``size`` of them each; ``packed`` if none has more rows than fit."""
        pairs = self.table.pairs if size.max() > _LARGE else None
        out = np.empty((1 if packed else 2, len(size), self.n))
        own = size > (max(_LARGE, pairs.n // 8) if pairs else len(rows))
        starts = np.cumsum(size) - size
        for i in np.flatnonzero(own):
            whole = pairs.single(self._whole(rows[starts[i]:starts[i] + size[i]], None, 1, packed, pairs)[:, 0])
            out[:, i] = whole[:, np.repeat(pairs.place[self.feats] - self.first, self.width) + np.arange(self.n)]
        if not own.all():
            if own.any():
                rows = rows[np.repeat(~own, size)]
            size = size[~own]
            out[:, ~own] = self._whole(rows, np.repeat(np.arange(len(size)), size), len(size), packed)
        out[:, :, self.first[1:]] -= out[:, :, :self.width[0]].sum(axis=2, keepdims=True)
        return out

    def _whole(self, rows: np.ndarray, seg: np.ndarray | None, k: int, packed: bool, pairs: _Pairs | None = None) -> np.ndarray:
        """Gradients and rows per node and cell, in one number or two."""
        if packed:
            return self._added(self.both, rows, seg, k, pairs)[None]
        if self.together < 64:
            return np.stack([self._added(self.grad, rows, seg, k, pairs), self._added(None, rows, seg, k, pairs)])
        out = 0
        for lo in range(0, max(1, len(rows)), self.together):
            mine = slice(lo, lo + self.together)
            out = out + np.stack(self.apart(self._added(self.both, rows[mine], seg if seg is None else seg[mine], k, pairs)))
        return out

    def apart(self, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and rows that share a double."""
        n = np.rint(both * (1 / self.unit))
        return both - n * self.unit, n

    def packed(self, sums: np.ndarray) -> np.ndarray:
        return (sums[0] + sums[1] * self.unit)[None]

    def best(self, sums: np.ndarray, total: np.ndarray, size: np.ndarray, g: GbtParams):
        """The best split of each node: its gain before the parent's share, feature and bin (the least of equal ones), and the gradients and
        rows of its left side."""
        left = np.cumsum(sums, axis=2)
        gl, nl = left if len(left) == 2 else self.apart(left[0])
        n, total = size[:, None].astype(np.float64), total[:, None].astype(np.float64)
        least = max(1, g.min_instances_per_node)
        gain = np.where((nl >= least) & (nl <= n - least), _gain(gl, nl, total, n, g), -np.inf)
        at = np.arange(len(gain)), gain.argmax(axis=1)
        return gain[at], self.feature[at[1]], self.bin[at[1]], gl[at].astype(np.int64), nl[at].astype(np.int64)


def grow(bins: np.ndarray, table: _Table, grad: np.ndarray, use: np.ndarray, feats: np.ndarray, g: GbtParams,
         root: int = 1) -> tuple[Nodes, np.ndarray]:
    """The tree (or the subtree under heap id ``root``) of the rows, grown on those in ``use``, and its value for all; ``table`` is
    ``by_bin(bins)``.

    Nodes are split by sums per bin, of which only the smaller child's are added up: the other's are what is left of the parent's. Nodes
    with far fewer rows than there are bins are set aside and split by sorted rows. A batch holds nodes of one depth; a node has its rows,
    first those that the tree grows on."""
    value, out = np.zeros(len(grad)), []
    square = np.square(grad / UNIT)
    sums, aside = None, []
    used = np.flatnonzero(use)
    batches = [(np.array([root]), [np.concatenate([used, np.flatnonzero(~use)])], np.array([len(used)]), grad[used].sum(keepdims=True), None)]
    while batches:
        ids, rows, size, total, above = batches.pop()
        k = len(ids)
        weight = leaf(total, size, g)
        opened = (size >= 2 * g.min_instances_per_node) & (size > 1) & (ids < 1 << g.max_depth)
        # no split gains more than the squares that it could remove
        squares = np.zeros(k)
        if opened.any():
            own = [rows[i][:size[i]] for i in np.flatnonzero(opened).tolist()]
            squares[opened] = np.add.reduceat(square[np.concatenate(own) if len(own) > 1 else own[0]], np.cumsum(size[opened]) - size[opened])
        opened &= squares * (1 + 1e-9) - np.square(total / UNIT) / (size + g.l2) >= g.min_split_loss
        if sums is None and opened.any():
            sums = _Sums(table, grad, used, feats)
        splits, feature, at = np.zeros(k, bool), np.full(k, -1), np.zeros(k, np.int64)
        small = opened & (size * len(feats) * _SORTED < sums.n if sums and sums.exact else True)
        opened &= ~small
        aside += [(ids[i], rows[i], size[i]) for i in np.flatnonzero(small)]
        if opened.any():
            have = _of_opened(sums, above, opened, size, rows)
            best, f, b, gl, nl = sums.best(have, total[opened], size[opened], g)
            good = _gains_enough(best, total[opened], size[opened], g)
            splits[opened], feature[opened], at[opened] = good, np.where(good, f, -1), np.where(good, b, 0)
            have, gl, nl = have[:, good], gl[good], nl[good]
        told = ~small
        out.append(Nodes(ids[told], feature[told], at[told], np.where(splits, 0.0, weight)[told]))
        ended = np.flatnonzero(~splits & ~small).tolist()
        if ended:
            value[np.concatenate([rows[i] for i in ended])] = np.repeat(weight[ended], [len(rows[i]) for i in ended])
        if splits.any():
            parents = np.flatnonzero(splits).tolist()
            below = _below(table, [rows[i] for i in parents], feature[parents], at[parents])
            ids = (2 * ids[splits][:, None] + np.arange(2)).ravel()
            size, total = (np.stack([x, y[splits] - x], axis=1).ravel() for x, y in ((nl, size), (gl, total)))
            step = 2 * max(1, _CELLS // sums.n)
            for lo in range(0, len(ids), step):
                hi = lo + step
                batches.append((ids[lo:hi], below[lo:hi], size[lo:hi], total[lo:hi], have[:, lo // 2:hi // 2]))
    if aside:
        ids, rows, size = zip(*aside, strict=True)
        mine = np.concatenate([r[:n] for r, n in zip(rows, size, strict=True)])
        nodes, value[mine] = _by_sorting(bins[mine], grad[mine], feats, g, np.array(ids), np.repeat(np.arange(len(ids)), size))
        out.append(nodes)
        _fill_in(bins, nodes, [(i, r[n:]) for i, r, n in aside], value)
    return Nodes(*[np.concatenate(x) for x in zip(*out, strict=True)]), value


def _below(table: _Table, rows: list[np.ndarray], feature: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The rows of the left and the right child of each node, in the order that they have: large nodes one by one, small ones together."""
    size = [len(r) for r in rows]
    out = []
    if sum(size) > _ALONE * len(size):
        for r, f, b in zip(rows, feature.tolist(), at.tolist(), strict=True):
            right = table.columns[f].take(r) > b
            out += [r[~right], r[right]]
        return out
    every = np.concatenate(rows)
    right = table.columns[np.repeat(feature, size), every] > np.repeat(at, size)
    child = np.repeat(np.arange(0, 2 * len(size), 2, dtype=np.uint16 if len(size) < 1 << 15 else np.int64), size) + right
    every = every[np.argsort(child, kind="stable")]
    ends = np.cumsum(np.bincount(child, minlength=2 * len(size))).tolist()
    return [every[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]


def _fill_in(bins: np.ndarray, nodes: Nodes, below: list[tuple[int, np.ndarray]], value: np.ndarray) -> None:
    """The values of rows that lie below nodes of a tree and that it has not grown on."""
    rows = np.concatenate([r for _, r in below])
    order = np.argsort(nodes.node)
    node, feature, bin_, weight = (x[order] for x in nodes)
    left = np.searchsorted(node, 2 * node)
    at = np.searchsorted(node, np.repeat([i for i, _ in below], [len(r) for _, r in below]))
    live = np.arange(len(rows))
    while len(live := live[feature[at[live]] >= 0]):
        here = at[live]
        at[live] = left[here] + (bins[rows[live], feature[here]] > bin_[here])
    value[rows] = weight[at]


def _of_opened(sums: _Sums, above: np.ndarray | None, opened: np.ndarray, size: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """The sums of the opened nodes, children in pairs of the nodes that ``above`` has the sums of."""
    packed = int(size.max()) <= sums.together
    if above is None:
        return sums.of(rows[0][:size[0]], size, packed)
    if packed and len(above) == 2:
        above = sums.packed(above)
    pairs = np.flatnonzero(opened[::2] | opened[1::2])
    lesser = 2 * pairs + (size[2 * pairs + 1] < size[2 * pairs])
    mine = np.concatenate([rows[i][:size[i]] for i in lesser.tolist()])
    less = sums.of(mine, size[lesser], packed)
    both = np.empty((len(less), len(pairs), 2, sums.n))
    side = lesser % 2
    both[:, np.arange(len(pairs)), side] = less
    both[:, np.arange(len(pairs)), 1 - side] = above[:, pairs] - less
    return both.reshape(len(less), -1, sums.n)[:, opened.reshape(-1, 2)[pairs].ravel()]


# ---- rounds ----------------------------------------------------------------------------------------------------------------------

def _batch(kind: int, n: int, **columns) -> pa.RecordBatch:
    columns["kind"] = np.full(n, kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _matrix(bins: pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(bins.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(len(bins), -1)


def _cut(nodes: Nodes, cuts: list[list[float]]) -> list[float | None]:
    return [None if f < 0 else cuts[f][b] for f, b in zip(nodes.feature.tolist(), nodes.bin.tolist(), strict=True)]


def _out(t: pa.Table, horizon: int, pred: np.ndarray, trees: list[tuple[int, Nodes]], cuts: list[list[float]]) -> pa.Table:
    parts = [_batch(ROW, len(t), horizon=np.full(len(t), horizon), key=t["key"].combine_chunks(), bins=t["bins"].combine_chunks(),
                    y=t["y"].combine_chunks(), pred=pred)]
    for tree, n in trees:
        size = len(n.node)
        parts.append(_batch(NODE, size, horizon=np.full(size, horizon), tree=np.full(size, tree), node=n.node, feature=n.feature, bin=n.bin,
                            cut=_cut(n, cuts), value=n.value))
    return pa.Table.from_batches(parts, _SCHEMA)


def chunk(first: int, rounds: int, cuts: list[list[float]], g: GbtParams) -> Callable[[pa.Table], pa.Table]:
    """``rounds`` rounds from ``first`` on, over all rows of one horizon: its rows with their new predictions, and the trees."""
    def run(t: pa.Table) -> pa.Table:
        horizon, key, y, pred, bins = t["horizon"][0].as_py(), t["key"].to_numpy(), t["y"].to_numpy(), t["pred"].to_numpy().copy(), _matrix(t["bins"])
        trees, table = [], by_bin(bins)
        for tree in range(first, first + rounds):
            nodes, value = grow(bins, table, gradients(pred, y), sampled(key, g, horizon, tree), chosen(bins.shape[1], g, horizon, tree), g)
            pred += value
            trees.append((tree, nodes))
        return _out(t, horizon, pred, trees, cuts)

    return run


def finish(tree: int, cuts: list[list[float]], g: GbtParams) -> Callable[[pa.Table], pa.Table]:
    """The subtree under one node, over its rows."""
    def run(t: pa.Table) -> pa.Table:
        horizon, root, key, bins = t["horizon"][0].as_py(), t["node"][0].as_py(), t["key"].to_numpy(), _matrix(t["bins"])
        pred = t["pred"].to_numpy()
        nodes, value = grow(bins, by_bin(bins), gradients(pred, t["y"].to_numpy()), sampled(key, g, horizon, tree),
                            chosen(bins.shape[1], g, horizon, tree), g, root)
        return _out(t, horizon, pred + value, [(tree, nodes)], cuts)

    return run


class Split(NamedTuple):
    feature: int
    bin: int


def _placed(horizon: np.ndarray, bins: np.ndarray, splits: dict[tuple[int, int], Split]) -> np.ndarray:
    """The heap id that each row reaches under the splits ``{(horizon, node): split}``."""
    at = np.ones(len(horizon), np.int64)
    keys = np.array(sorted((h << 32) + n for h, n in splits), np.int64)
    found = [splits[(int(k) >> 32, int(k) & 0xFFFFFFFF)] for k in keys]
    feature, cut = (np.array([s[i] for s in found], np.int64) for i in (0, 1))
    live = np.arange(len(horizon)) if len(keys) else np.zeros(0, np.int64)
    while len(live):
        k = (horizon[live].astype(np.int64) << 32) + at[live]
        i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        on = keys[i] == k
        live, i = live[on], i[on]
        at[live] = 2 * at[live] + (bins[live, feature[i]] > cut[i])
    return at


def _sums(tree: int, splits: dict, opened: list[tuple[int, int]], g: GbtParams, n_features: int) -> Callable:
    """Per task and open node, the gradients and rows per feature and bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {o: np.zeros((2, n_features * g.max_bins)) for o in opened}
        for b in batches:
            t = pa.Table.from_batches([b])
            horizon, key, bins = t["horizon"].to_numpy(), t["key"].to_numpy(), _matrix(t["bins"])
            grad, at = gradients(t["pred"].to_numpy(), t["y"].to_numpy()), _placed(horizon, bins, splits)
            place = np.arange(n_features) * g.max_bins
            for (h, n), s in sums.items():
                which = np.flatnonzero((horizon == h) & (at == n))
                which = which[sampled(key[which], g, h, tree)]
                cell = (bins[which] + place).ravel()
                s[0] += np.bincount(cell, np.repeat(grad[which].astype(np.float64), n_features), s.shape[1])
                s[1] += np.bincount(cell, minlength=s.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in opened], pa.int32()), pa.array([o[1] for o in opened], pa.int32()),
                                          pa.array([s.astype(np.int64).tobytes() for s in sums.values()], pa.binary())], names=["horizon", "node", "sums"])

    return run


def _chosen_split(tree: int, g: GbtParams) -> Callable:
    """The best split of one open node from the tasks' sums."""
    def run(t: pa.Table) -> pa.Table:
        h, node = t["horizon"][0].as_py(), t["node"][0].as_py()
        whole = sum(np.frombuffer(x, np.int64) for x in t["sums"].to_pylist()).reshape(2, -1, g.max_bins)
        gl, nl = np.cumsum(whole[0], axis=1), np.cumsum(whole[1], axis=1)
        total, n = int(gl[0, -1]), int(nl[0, -1])
        feats = chosen(whole.shape[1], g, h, tree)
        fits = (nl[feats] >= g.min_instances_per_node) & (n - nl[feats] >= g.min_instances_per_node)
        gain = np.where(fits, _gain(gl[feats], nl[feats], total, n, g), -np.inf)
        f, b = np.unravel_index(gain.argmax(), gain.shape)
        good = gain[f, b] - (total / UNIT) ** 2 / (n + g.l2) >= max(g.min_split_loss, 1e-6)
        f = int(feats[f])
        left = (int(gl[f, b]), int(nl[f, b])) if good else (0, 0)
        row = (h, node, f if good else -1, int(b), total, n, *left)
        return pa.table([pa.array([x], pa.int32() if i < 4 else pa.int64()) for i, x in enumerate(row)],
                        names=["horizon", "node", "feature", "bin", "total", "n", "left_total", "left_n"])

    return run


def large_round(state: DataFrame, counts: dict[int, int], tree: int, cuts: list[list[float]], g: GbtParams) -> DataFrame:
    """One round of horizons with more than ``group_rows`` rows (``counts``): the new state, rows and nodes of this tree."""
    splits: dict[tuple[int, int], Split] = {}
    ended: dict[tuple[int, int], float] = {}
    opened = [(h, 1) for h in counts]
    for depth in range(g.max_depth):
        if not opened:
            break
        sums = state.mapInArrow(_sums(tree, splits, opened, g, len(cuts)), "horizon int, node int, sums binary")
        found = sums.groupBy("horizon", "node").applyInArrow(
            _chosen_split(tree, g), "horizon int, node int, feature int, bin int, total long, n long, left_total long, left_n long").collect()
        opened = []
        for r in found:
            at = (r["horizon"], r["node"])
            if r["feature"] < 0:
                ended[at] = float(leaf(r["total"], r["n"], g))
                continue
            splits[at] = Split(r["feature"], r["bin"])
            for side, total, n in ((0, r["left_total"], r["left_n"]), (1, r["total"] - r["left_total"], r["n"] - r["left_n"])):
                child = (at[0], 2 * at[1] + side)
                if n > g.group_rows:
                    opened.append(child)
                    if depth + 1 == g.max_depth:
                        ended[child] = float(leaf(total, n, g))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            horizon = t["horizon"].to_numpy()
            at = _placed(horizon, _matrix(t["bins"]), splits)
            more = np.array([ended.get(x, np.nan) for x in zip(horizon.tolist(), at.tolist(), strict=True)], np.float64)
            over = ~np.isnan(more)
            columns = {f.name: b.column(i) for i, f in enumerate(_SCHEMA)}
            columns |= {"node": pa.array(at, pa.int32(), mask=over), "pred": pa.array(t["pred"].to_numpy() + np.where(over, more, 0))}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in _SCHEMA], schema=_SCHEMA)

    placed = state.mapInArrow(place, STATE)
    small = placed.where(F.col("node").isNotNull()).groupBy("horizon", "node").applyInArrow(finish(tree, cuts, g), STATE)
    upper = [(h, tree, n, s.feature, s.bin, cuts[s.feature][s.bin], 0.0) for (h, n), s in splits.items()]
    upper += [(h, tree, n, -1, 0, None, w) for (h, n), w in ended.items()]
    names = "horizon int, tree int, node int, feature int, bin int, cut double, value double"
    nodes = state.sparkSession.createDataFrame(upper, names).withColumn("kind", F.lit(NODE))
    return small.unionByName(placed.where(F.col("node").isNull())).unionByName(nodes, allowMissingColumns=True)
