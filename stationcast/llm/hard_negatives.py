"""Hard negatives by angular triangle filtering: stored angles bound every inner product, overlapping windows are scored exactly.

A vector is scaled and floored to integers. A bounded sample of vectors (``REFERENCES``) gives reference directions; every vector
stores its norm and its angle to each. By the triangle inequality the angle between an anchor a and a vector v lies between
``max_r |a_r - v_r|`` and ``min_r min(a_r + v_r, 2 pi - a_r - v_r)``; the cosines of both, times the norms and widened by
a margin for rounding, bound their inner product.

1. Vectors are dealt into cells, a block of anchors against a block of vectors (``dealt``): stated queries against all rows. In a
   cell, vectors stand in windows of ``WINDOW`` by nearest reference and angle, and bounds are taken per anchor and window.
2. Positives: per label, an anchor's best ``positives`` other rows. A window is scored for the anchors whose best rows so far its
   upper bound can pass.
3. Negatives: each positive score p asks for scores in ``[low % of p, high % of p]``. A window is scored for the anchors one of
   whose ranges overlaps its interval; the best ``negatives`` of other labels stay.
4. The few rows that each cell keeps of an anchor meet in a window ranking, limited before its shuffle.

Scores are exact: float64 products where the norms bound them below 2^47, Python integers beyond. The references only bound work:
whatever they are, every row is indexed and the result is that of the brute force.

Bounds: a cell holds two blocks of ``BLOCK`` rows at most (on average; rows are dealt by hash of a row number, so a hot label or id
spreads evenly), and nothing but the references reaches the driver.

Defined cases: rows with a NULL id, label, vector or a NULL or non-finite component take no part; vectors of different lengths
are padded with zeros; a repeated row is another row, as anchor, positive and negative; ties go to the smaller id; scores
beyond 64 bits are ranked exactly in a cell and clipped to 64 bits on leaving it, where ranges go by the clipped score; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from .common import written

SCALE = 256
REFERENCES = 16            # rows whose directions serve as references: a bounded sample, the first by hash of the id
BLOCK = 16384
LEAST_BLOCK = 1024
WINDOW = 128
ANGLE_SLACK = 1e-5         # radians, covers single-precision storage twice over
EXACT = float(1 << 47)
LONG = np.iinfo(np.int64)
_VECTOR = "vec_id long, label long, q binary"
_INDEX = "row long, vec_id long, label long, q binary, norm double, angles binary"


def vectors(table: DataFrame) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part; ``q`` holds floor(256 x) as doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat = lists.flatten()
            x = np.floor(SCALE * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
            good = (bad[ends] == bad[starts]) if len(ends) else np.zeros(0, bool)
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [x[lo:hi].tobytes() for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())], names=["vec_id", "label", "q"])
            yield out.filter(pa.array(good))

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = (table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
             .select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("q")))
    return known.mapInArrow(run, _VECTOR)


def _matrix(raw: list[bytes], width: int = 0) -> np.ndarray:
    """Vectors as rows, padded with zeros to the longest or to ``width``."""
    size = max([width, *(len(r) // 8 for r in raw)])
    if all(len(r) == 8 * size for r in raw):
        return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), size)
    out = np.zeros((len(raw), size))
    for i, r in enumerate(raw):
        out[i, :len(r) // 8] = np.frombuffer(r, np.float64)
    return out


def _scaled_norms(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and rows scaled so that their largest component is 1 (no overflow)."""
    top = np.abs(m).max(axis=1, initial=0)
    unit = m / np.where(top > 0, top, 1)[:, None]
    return top * np.sqrt((unit * unit).sum(axis=1)), unit


def indexed(rows: DataFrame, references: int = REFERENCES) -> DataFrame:
    """``rows`` with a row number, norm and the angles to the reference directions, written."""
    kept = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sample = [r["q"] for r in kept.orderBy(F.xxhash64("vec_id"), "row").limit(references).collect()]
    refs = _scaled_norms(_matrix([bytes(x) for x in sample]))[1] if sample else np.zeros((0, 0))
    length = np.sqrt((refs * refs).sum(axis=1))
    refs = (refs / np.where(length > 0, length, 1)[:, None])[length > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m = _matrix(b.column(3).to_pylist(), refs.shape[1])
            norm, unit = _scaled_norms(m)
            size = np.sqrt((unit * unit).sum(axis=1))
            wide = np.zeros((len(refs), m.shape[1]))
            wide[:, :refs.shape[1]] = refs
            angles = np.arccos(np.clip(unit @ wide.T / np.where(size > 0, size, 1)[:, None], -1, 1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(norm), pa.array(
                [a.tobytes() for a in angles], pa.binary())], names=["row", "vec_id", "label", "q", "norm", "angles"])

    return written(kept.select("row", "vec_id", "label", "q").mapInArrow(run, _INDEX), "vector_index")


class Side:
    """One side of a cell: the rows of an Arrow table as arrays."""

    def __init__(self, t: pa.Table):
        self.row, self.id, self.label = (t.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.q = _matrix(t.column("q").to_pylist())
        self.norm = t.column("norm").to_numpy()
        self.angles = np.frombuffer(b"".join(t.column("angles").to_pylist()), np.float32).reshape(len(self.row), -1).astype(np.float64)

    def take(self, order: np.ndarray) -> None:
        for f in ("row", "id", "label", "q", "norm", "angles"):
            setattr(self, f, getattr(self, f)[order])


def bounds(anchors: Side, block: Side, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orders ``block`` into windows; their starts, and per anchor and window the least and the greatest score possible."""
    n_refs = block.angles.shape[1]
    near = block.angles.argmin(axis=1) if n_refs else np.zeros(len(block.row), np.int64)
    block.take(np.lexsort((block.angles[np.arange(len(near)), near], near)) if n_refs else np.arange(len(near)))
    starts = np.arange(0, len(block.row), window)
    least, most = np.zeros((len(anchors.row), len(starts))), np.full((len(anchors.row), len(starts)), np.pi)
    for r in range(n_refs):
        a = anchors.angles[:, r][:, None]
        lo, hi = (f.reduceat(block.angles[:, r], starts)[None] for f in (np.minimum, np.maximum))
        np.maximum(least, np.maximum(a - hi, lo - a) - ANGLE_SLACK, out=least)
        np.minimum(most, np.minimum(a + hi, 2 * np.pi - a - lo) + ANGLE_SLACK, out=most)
    near_cos, far_cos = np.cos(np.clip(least, 0, np.pi)), np.cos(np.clip(most, 0, np.pi))
    small, large = (f.reduceat(block.norm, starts)[None] * anchors.norm[:, None] for f in (np.minimum, np.maximum))
    low, high = np.minimum(far_cos * small, far_cos * large), np.maximum(near_cos * small, near_cos * large)
    margin = 1 + 1e-9 * large
    return starts, low - margin, high + margin


class Scorer:
    """Exact scores of a cell, as keys that order by score, then by smaller id and row."""

    def __init__(self, anchors: Side, block: Side):
        width = max(anchors.q.shape[1], block.q.shape[1])
        a, b = (np.pad(s.q, ((0, 0), (0, width - s.q.shape[1]))) for s in (anchors, block))
        self.exact = anchors.norm.max(initial=0) * block.norm.max(initial=0) < EXACT
        self.a, self.b = (a, b) if self.exact else (np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (a, b))
        self.by_id = np.lexsort((block.row, block.id))
        self.rank = np.empty(len(block.row), np.int64)
        self.rank[self.by_id] = np.arange(len(block.row))[::-1]
        self.shift = 1 << int(len(block.row)).bit_length()          # 2^15 at most, so that keys stay below 2^63
        self.none = LONG.min if self.exact else -(1 << 2200)

    def scores(self, which: np.ndarray, part: slice) -> np.ndarray:
        s = self.a[which] @ self.b[part].T
        return s.astype(np.int64) if self.exact else s

    def keys(self, scores: np.ndarray, part: slice) -> np.ndarray:
        return scores * self.shift + (self.rank[part] if self.exact else self.rank[part].astype(object))

    def blank(self, *shape: int) -> np.ndarray:
        return np.full(shape, self.none, np.int64 if self.exact else object)

    def best(self, have: np.ndarray, more: np.ndarray) -> np.ndarray:
        """The largest keys of both along the last axis, as many as ``have`` has, ascending."""
        k = have.shape[-1]
        both = np.concatenate([have, more], axis=-1)
        if self.exact and both.shape[-1] > 4 * k:
            both = np.partition(both, both.shape[-1] - k, axis=-1)[..., -k:]
        return np.sort(both, axis=-1)[..., -k:]

    def decoded(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores and the places in the block of keys."""
        scores = keys // self.shift
        return scores, self.by_id[::-1][(keys - scores * self.shift).astype(np.int64)]


def _as_long(scores) -> pa.Array:
    return pa.array([min(max(int(s), LONG.min), LONG.max) for s in scores], pa.int64())


def _floor(scorer: Scorer, keys: np.ndarray) -> np.ndarray:
    """The scores of keys as floats, minus infinity where there is none."""
    none = keys == scorer.none
    return np.where(none, -np.inf, np.where(none, 0, keys // scorer.shift).astype(np.float64))


def _positives(k: int) -> Callable:
    """Of a cell of one label, each anchor's best ``k`` other rows."""
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        anchors, rows = Side(asked), Side(block)
        out: list[list] = [[], [], [], [], []]
        if len(anchors.row) and len(rows.row):
            starts, low, high = bounds(anchors, rows)
            scorer = Scorer(anchors, rows)
            have = scorer.blank(len(anchors.row), k)
            size = np.diff(np.append(starts, len(rows.row)))
            first = high.argmax(axis=1)
            for sweep in (0, 1):                    # each anchor's most promising window first, then the others that can matter
                for w, lo in enumerate(starts):
                    if sweep == 0:
                        which = np.flatnonzero(first == w)
                    else:
                        which = np.flatnonzero((first != w) & (high[:, w] >= _floor(scorer, have[:, 0])))
                    if len(which):
                        part = slice(lo, lo + size[w])
                        keys = scorer.keys(scorer.scores(which, part), part)
                        keys[anchors.row[which][:, None] == rows.row[part][None]] = scorer.none
                        have[which] = scorer.best(have[which], keys)
            a, j = np.nonzero(have != scorer.none)
            scores, at = scorer.decoded(have[a, j])
            out = [anchors.row[a], anchors.id[a], rows.row[at], rows.id[at], scores]
        return pa.table([*[pa.array(x, pa.int64()) for x in out[:4]], _as_long(out[4])], names=["a_row", "anchor_id", "p_row", "positive_id", "positive_score"])

    return run


def _negatives(k: int, low_percent: int, high_percent: int) -> Callable:
    """Of a cell, for each anchor and positive the best ``k`` rows of other labels within the positive's range."""
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        anchors, rows = Side(asked), Side(block)
        out: list = [[], [], [], [], []]
        if len(anchors.row) and len(rows.row):
            places = asked.column("p_rows").to_pylist()
            wanted = asked.column("p_scores").to_pylist()
            n = max(map(len, wanted))
            starts, low, high = bounds(anchors, rows)
            scorer = Scorer(anchors, rows)
            there = np.array([[j < len(w) for j in range(n)] for w in wanted])
            small = scorer.exact and max(abs(x) for w in wanted for x in w) < 1 << 55      # its percentages fit 64 bits
            p = np.array([[*w, *[0] * (n - len(w))] for w in wanted], np.int64 if small else object)
            least, most = p.astype(np.float64) * (low_percent / 100), p.astype(np.float64) * (high_percent / 100)
            slack = 1 + 1e-9 * np.abs(least)
            have = scorer.blank(len(anchors.row), n, k)
            size = np.diff(np.append(starts, len(rows.row)))
            for w, lo in enumerate(starts):
                floor = np.maximum(least - slack, _floor(scorer, have[:, :, 0]))
                meets = there & (p >= 0) & (high[:, w][:, None] >= floor) & (low[:, w][:, None] <= most + slack)
                which = np.flatnonzero(meets.any(axis=1))
                if not len(which):
                    continue
                part = slice(lo, lo + size[w])
                s = scorer.scores(which, part)
                other = anchors.label[which][:, None] != rows.label[part][None]
                keys = scorer.keys(s, part)
                for j in range(n):
                    pj = p[which, j][:, None]
                    inside = other & meets[which, j][:, None] & (low_percent * pj <= 100 * s) & (100 * s <= high_percent * pj)
                    hit = np.flatnonzero(inside.any(axis=1))
                    if len(hit):
                        have[which[hit], j] = scorer.best(have[which[hit], j], np.where(inside[hit], keys[hit], scorer.none))
            a, j, i = np.nonzero(have != scorer.none)
            scores, at = scorer.decoded(have[a, j, i])
            out = [anchors.row[a], [places[x][y] for x, y in zip(a.tolist(), j.tolist(), strict=True)], rows.row[at], rows.id[at], scores]
        return pa.table([*[pa.array(x, pa.int64()) for x in out[:4]], _as_long(out[4])], names=["a_row", "p_row", "n_row", "negative_id", "negative_score"])

    return run


def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
    """``rows`` in cells: each in one block of its own side (``own`` is how many there are), for every block of the other side."""
    return (rows.withColumn(f"{own}_cell", F.pmod(F.xxhash64("row"), F.col(own)).cast("int"))
            .withColumn(f"{other}_cell", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("a", "r"))


def mine(table: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors ``vec_id % every = 0``."""
    index = indexed(vectors(table))
    spark = index.sparkSession
    is_anchor = F.col("vec_id") % every == 0
    anchors = index.where(is_anchor).toDF(*index.columns)
    n, m = index.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, F.lit(1)))).first()
    block = min(BLOCK, max(LEAST_BLOCK, n // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))

    def blocks(rows):
        return F.greatest(F.ceil(rows / block), F.lit(1)).cast("int")

    sizes = sized_broadcast(index.groupBy("label").agg(blocks(F.count(F.lit(1))).alias("r"), F.count(F.when(is_anchor, F.lit(1))).alias("m"))
                            .where("m > 0").select("label", "r", blocks(F.col("m")).alias("a")))
    by = ["label", "a_cell", "r_cell"]
    near = dealt(index.join(sizes, "label"), "r", "a").groupBy(*by).cogroup(dealt(anchors.join(sizes, "label"), "a", "r").groupBy(*by)).applyInArrow(
        _positives(positives), "a_row long, anchor_id long, p_row long, positive_id long, positive_score long")
    best = Window.partitionBy("a_row").orderBy(F.desc("positive_score"), "positive_id", "p_row")
    found = written(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "positives")

    ranges = found.groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct("place", "p_row", "positive_score"))).alias("p"))
    asked = (anchors.join(ranges, anchors["row"] == ranges["a_row"]).drop("a_row")
             .withColumn("p_rows", F.transform("p", lambda x: x["p_row"])).withColumn("p_scores", F.transform("p", lambda x: x["positive_score"])).drop("p"))
    by = ["a_cell", "r_cell"]
    sides = [x.withColumn("r", blocks(F.lit(n))).withColumn("a", blocks(F.lit(m))) for x in (index, asked)]
    hard = dealt(sides[0], "r", "a").groupBy(*by).cogroup(dealt(sides[1], "a", "r").groupBy(*by)).applyInArrow(
        _negatives(negatives, low_percent, high_percent), "a_row long, p_row long, n_row long, negative_id long, negative_score long")
    first = Window.partitionBy("a_row", "p_row").orderBy(F.desc("negative_score"), "negative_id", "n_row")
    ranked = hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return (ranked.join(found.drop("place"), ["a_row", "p_row"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"))
