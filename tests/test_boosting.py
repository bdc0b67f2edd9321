"""Trees against a plain version, large horizons against small ones, resumed and broken trainings, scoring."""

from __future__ import annotations

import datetime as dt
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stationcast.operators import boosting as B
from stationcast.operators import models as M
from stationcast.params import GbtParams, Params
from stationcast.session import exists, names_in

AS_OF = dt.date(2001, 11, 5)
G = GbtParams(max_iter=6, max_depth=5, chunk_rounds=4, max_bins=16)
P = Params(as_of=AS_OF, fr_len=3, iter_count=4, gbt=G)


def plain_tree(bins, grad, use, feats, g, node=1, depth=0):
    """The nodes ``{heap id: (feature, bin, value)}`` by trying every split of every node."""
    rows = np.flatnonzero(use)
    total, n = int(grad[rows].sum()), len(rows)
    best = (-np.inf, 0, 0)
    if depth < g.max_depth:
        for f in feats:
            for b in sorted(set(bins[rows, f].tolist())):
                left = rows[bins[rows, f] <= b]
                if min(len(left), n - len(left)) >= g.min_instances_per_node:
                    gain = float(B._gain(np.int64(grad[left].sum()), len(left), total, n, g))
                    if gain > best[0]:
                        best = (gain, int(f), b)
    if best[0] - (total / B.UNIT) ** 2 / (n + g.l2) < g.min_split_loss:
        return {node: (-1, 0, float(B.leaf(total, n, g)))}
    _, f, b = best
    out = {node: (f, b, 0.0)}
    for side in (0, 1):
        out |= plain_tree(bins, grad, use & ((bins[:, f] > b) == side), feats, g, 2 * node + side, depth + 1)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 150])
def test_tree_equals_trying_every_split(n):
    rng = np.random.default_rng(n)
    bins, y = rng.integers(0, 9, (n, 7)).astype(np.uint8), rng.integers(0, 50, n).astype(float)
    grad, use, feats = B.gradients(np.full(n, 0.5), y), rng.random(n) < 0.8, np.array([0, 2, 3, 6])
    nodes, value = B.grow(bins, B.by_bin(bins), grad, use, feats, G)
    want = plain_tree(bins, grad, use, feats, G)
    got = {i: (f, b, v) for i, f, b, v in zip(*[x.tolist() for x in nodes], strict=True)}
    assert got == want
    for r in range(n):
        at = 1
        while want[at][0] >= 0:
            at = 2 * at + int(bins[r, want[at][0]] > want[at][1])
        assert value[r] == want[at][2]


@pytest.mark.parametrize("scale, sorted_below", [(1, 0), (1, 1 << 40), (1, 1), (40, 1), (10 ** 6, 1), (10 ** 9, 1)])
def test_sums_per_bin_and_sorted_rows_give_the_same_tree(monkeypatch, scale, sorted_below):
    """Both ways, both mixed, sums and row counts in two numbers, and gradients too large for a double."""
    monkeypatch.setattr(B, "_SORTED", sorted_below)
    monkeypatch.setattr(B, "_CELLS", 100)                          # several batches a level
    n, g = 260, GbtParams(max_iter=1, max_depth=9, max_bins=32)
    rng = np.random.default_rng(scale)
    bins, y = rng.integers(0, 32, (n, 6)).astype(np.uint8), rng.integers(0, 50, n) * float(scale)
    bins[:, 2] = 3                                                 # nothing to split on
    bins[:, 4] = bins[:, 1]                                        # equal gains: the first feature is taken
    grad, use, feats = B.gradients(np.full(n, 0.5), y), rng.random(n) < 0.8, np.array([0, 1, 2, 4, 5])
    nodes, value = B.grow(bins, B.by_bin(bins), grad, use, feats, g)
    want = plain_tree(bins, grad, use, feats, g)
    assert {i: (f, b, v) for i, f, b, v in zip(*[x.tolist() for x in nodes], strict=True)} == want and len(want) == len(nodes.node) > 9
    for r in range(n):
        at = 1
        while want[at][0] >= 0:
            at = 2 * at + int(bins[r, want[at][0]] > want[at][1])
        assert value[r] == want[at][2]


def test_rows_are_added_up_for_the_smaller_child_only(monkeypatch):
    """Outliers come off one pair at a time, so every level still holds nearly all rows."""
    n, g = 3000, GbtParams(max_depth=15)
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 20, (n, 8)).astype(np.uint8)
    bins[:, 0] = np.minimum(np.arange(n) // 2, 40)
    y = np.where(bins[:, 0] < 30, 2.0 ** (30 - bins[:, 0].astype(float)), 0.5)
    read, of = [], B._Sums.of
    monkeypatch.setattr(B._Sums, "of", lambda self, rows, *a: read.append(len(rows)) or of(self, rows, *a))
    nodes, _ = B.grow(bins, B.by_bin(bins), B.gradients(np.full(n, 0.5), y), np.ones(n, bool), np.arange(8), g)
    assert int(nodes.node.max()).bit_length() == 16 and n <= sum(read) < 1.1 * n


def test_nodes_that_cannot_gain_enough_are_not_looked_at(monkeypatch):
    n = 400
    bins = np.random.default_rng(4).integers(0, 20, (n, 8)).astype(np.uint8)
    monkeypatch.setattr(B, "_Sums", lambda *a: pytest.fail("looked at"))
    monkeypatch.setattr(B, "_by_sorting", lambda *a: pytest.fail("looked at"))
    grad = B.gradients(np.full(n, 0.5), np.full(n, 2.5))           # large, but all alike
    nodes, value = B.grow(bins, B.by_bin(bins), grad, np.ones(n, bool), np.arange(8), GbtParams(l2=0.0))
    assert nodes.node.tolist() == [1] and set(value.tolist()) == {float(B.leaf(grad.sum(), n, GbtParams(l2=0.0)))}


@pytest.mark.parametrize("scale, paired", [(1, 512), (1, 30), (1, 400), (10 ** 6, 512), (10 ** 7, 512)])
def test_pairs_of_features_give_the_same_tree(monkeypatch, scale, paired):
    """Features of 1 to 40 bins in pairs and alone, an odd one out, rows and gradients in one double or two."""
    for name, to in (("_LARGE", 3), ("_PAIRED", paired), ("_BLOCK", 50), ("_SORTED", 1 << 40), ("_ALONE", paired - 400)):
        monkeypatch.setattr(B, name, to)
    n, g = 300, GbtParams(max_iter=1, max_depth=7, max_bins=64)
    rng = np.random.default_rng(scale + paired)
    bins = np.stack([rng.integers(0, w, n) for w in (5, 40, 9, 1, 17, 17, 2, 30, 12)], axis=1).astype(np.uint8)
    y = rng.integers(0, 50, n) * float(scale)
    grad, use, feats = B.gradients(np.full(n, 0.5), y), rng.random(n) < 0.7, np.array([0, 1, 2, 3, 5, 6, 8])
    added, single = [], B._Pairs.single
    monkeypatch.setattr(B._Pairs, "single", lambda self, sums: added.append(self.count) or single(self, sums))
    nodes, value = B.grow(bins, B.by_bin(bins), grad, use, feats, g)
    want = plain_tree(bins, grad, use, feats, g)
    assert {i: (f, b, v) for i, f, b, v in zip(*[x.tolist() for x in nodes], strict=True)} == want and len(want) == len(nodes.node) > 5
    assert set(added) == ({30: set(), 400: {6}}.get(paired, {5}))          # too few pairs save nothing
    for r in range(n):
        at = 1
        while want[at][0] >= 0:
            at = 2 * at + int(bins[r, want[at][0]] > want[at][1])
        assert value[r] == want[at][2]


def test_rows_are_added_up_in_steps():
    """The memory for it follows neither the rows nor the features."""
    n, g = 40_000, GbtParams(max_iter=1)
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 17, (n, 64)).astype(np.uint8), rng.integers(0, 50, n).astype(float)
    grad, table = B.gradients(np.full(n, 0.5), y), B.by_bin(bins)
    tracemalloc.start()
    try:
        B.grow(bins, table, grad, np.ones(n, bool), np.arange(64), g)
        assert tracemalloc.get_traced_memory()[1] < n * 64 * 6      # a number per row and feature takes 8 bytes
    finally:
        tracemalloc.stop()


def test_a_horizon_of_the_usual_size_is_boosted_in_one_task(spark, tmp_path, monkeypatch):
    """60 times sf0.1 has 180,000 rows a horizon; a job per level and round takes hours."""
    rows, p = 60_000, P.with_(fr_len=1, gbt=GbtParams(max_iter=3, max_depth=2, chunk_rounds=4))
    made = spark.range(rows).select(
        F.col("id").cast("string").alias("sta_num"), F.lit(AS_OF - dt.timedelta(days=18)).alias("pre_end"),
        array_to_vector(F.array(*[(F.col("id") % m).cast("double") for m in (7, 11)])).alias("features"), F.array(F.col("id") % 5 + 1).alias("labels"))
    made.write.parquet(str(tmp_path / "features"))
    monkeypatch.setattr(B, "large_round", lambda *a: pytest.fail("grown over all partitions"))
    found = M.fit_models(spark, lambda: str(tmp_path / "features"), p, str(tmp_path / "store"))
    assert found["horizons"]["0"]["rows"] == rows and found["horizons"]["0"]["trees"] == 3


def feature_table(spark, rows: int = 60, seed: int = 1):
    """Feature rows like those of the training job: ``sta_num, pre_end, features, labels``."""
    rng = np.random.default_rng(seed)
    days = [AS_OF - dt.timedelta(days=d) for d in range(8, 8 + 70)]
    data = [(str(i), d, [float(x) for x in rng.integers(0, 12, 5)], [int(x) for x in rng.integers(0, 40, P.fr_len)]) for i in range(rows) for d in days[::3]]
    made = spark.createDataFrame(data, "sta_num string, pre_end date, x array<double>, labels array<long>")
    return made.withColumn("features", array_to_vector("x")).drop("x")


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "features")
    feature_table(spark).write.partitionBy("pre_end").parquet(path)
    return path


def trees(spark, root: str, p: Params = P) -> list[tuple]:
    return sorted(tuple(r) for r in M.nodes(spark, root, M.model_date_for_training(p.as_of), p).select(
        "horizon", "tree", "node", "feature", "cut", "value").fillna(-1.0, ["cut"]).collect())


def with_gbt(**changes) -> Params:
    return P.with_(gbt=GbtParams(**{**G.__dict__, **changes}))


def test_horizons_grown_over_all_partitions_equal_those_of_one_task(spark, table, tmp_path):
    small = M.fit_models(spark, lambda: table, P, str(tmp_path / "small"))
    rows = small["horizons"]["0"]["rows"]
    for bound in (20, rows // 3, rows - 1):
        large = with_gbt(group_rows=bound)
        M.fit_models(spark, lambda: table, large, str(tmp_path / f"large{bound}"))
        assert trees(spark, str(tmp_path / f"large{bound}"), large) == trees(spark, str(tmp_path / "small"))


def test_model_depends_neither_on_partitions_nor_on_chunks(spark, table, tmp_path):
    M.fit_models(spark, lambda: table, P, str(tmp_path / "a"))
    again = str(tmp_path / "again")
    spark.read.parquet(table).repartition(7, F.rand(3)).write.partitionBy("pre_end").parquet(again)
    M.fit_models(spark, lambda: again, with_gbt(chunk_rounds=1), str(tmp_path / "b"))
    assert trees(spark, str(tmp_path / "a")) == trees(spark, str(tmp_path / "b"))


def test_a_stopped_training_goes_on_and_gives_the_same_model(spark, table, tmp_path, monkeypatch):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    M.fit_models(spark, lambda: table, P, whole)
    chunk = B.chunk

    def stops(first, *rest):
        if first >= 4:
            raise RuntimeError("lost")
        return chunk(first, *rest)

    monkeypatch.setattr(B, "chunk", stops)
    with pytest.raises(RuntimeError, match="lost"):
        M.fit_models(spark, lambda: table, P, broken, "week")
    with pytest.raises(M.MissingModel):
        trees(spark, broken)
    monkeypatch.setattr(B, "chunk", chunk)

    def no_table():
        raise AssertionError("the feature table is not needed again")

    with pytest.raises(ValueError, match="other settings"):
        M.fit_models(spark, no_table, with_gbt(seed=8), broken, "week")
    M.fit_models(spark, no_table, P, broken, "week")
    assert trees(spark, broken) == trees(spark, whole)
    date = M.date_path(broken, M.model_date_for_training(AS_OF))
    assert [n for n in names_in(spark, f"{date}/attempt=week") if n.startswith("round=")] == []


def test_a_training_that_breaks_off_leaves_the_committed_set(spark, table, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    M.fit_models(spark, lambda: table, P, root, "first")
    before = trees(spark, root)
    commit = M.commit
    monkeypatch.setattr(M, "commit", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError, match="no space"):
        M.fit_models(spark, lambda: table, with_gbt(seed=9), root, "second")
    assert trees(spark, root) == before
    monkeypatch.setattr(M, "commit", commit)
    M.fit_models(spark, lambda: table, with_gbt(seed=9), root, "third")
    assert trees(spark, root, with_gbt(seed=9)) != before
    date = M.model_date_for_training(AS_OF)
    M.drop_old(spark, root, date)
    assert [n for n in names_in(spark, M.date_path(root, date)) if not n.startswith(".")] == ["attempt=third", "manifest-00002.json"]
    assert trees(spark, root, with_gbt(seed=9))


def test_scores_equal_walking_each_tree_and_follow_the_labels(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "SLICE_NODES", 50)                     # several slices
    root = str(tmp_path / "store")
    M.fit_models(spark, lambda: table, P, root)
    date = M.model_date_for_training(AS_OF)
    feats = spark.read.parquet(table).where(F.col("pre_end") == F.lit(AS_OF - dt.timedelta(days=8))).select("sta_num", "features")
    got = {r["sta_num"]: r["forecast"] for r in M.score(feats, root, date, P).collect()}
    by_tree: dict = {}
    for h, t, node, f, cut, value in trees(spark, root):
        by_tree.setdefault((h, t), {})[node] = (f, cut, value)
    for r in feats.collect():
        want = [G.base_score] * P.fr_len
        for (h, _), tree in by_tree.items():
            at = 1
            while tree[at][0] >= 0:
                at = 2 * at + int(r["features"][tree[at][0]] > tree[at][1])
            want[h] += tree[at][2]
        assert got[r["sta_num"]] == pytest.approx(want, abs=1e-9)
    assert len(got) == 60


def test_nodes_are_copied_once_per_block_of_rows_not_per_partition(spark, table, tmp_path, monkeypatch):
    root, date = str(tmp_path / "store"), M.model_date_for_training(AS_OF)
    M.fit_models(spark, lambda: table, P, root)
    feats = spark.read.parquet(table).where(F.col("pre_end") == F.lit(AS_OF - dt.timedelta(days=8))).select("sta_num", "features")

    def blocks():
        plan = M.score(feats, root, date, P)._jdf.queryExecution().analyzed().toString()
        return re.findall(r"explode\(sequence\(0, (\d+)", plan)

    assert feats.count() == 60 and blocks() == ["0", "0"]                    # one slice, one block
    want = {r["sta_num"]: r["forecast"] for r in M.score(feats, root, date, P).collect()}
    monkeypatch.setattr(M, "BLOCK_ROWS", 7)
    assert sorted(blocks()) == ["0", "8"]
    got = {r["sta_num"]: r["forecast"] for r in M.score(feats, root, date, P).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert M.score(feats.limit(0), root, date, P).collect() == []


def test_features_are_scanned_once(spark, table, tmp_path):
    root = str(tmp_path / "store")
    M.fit_models(spark, lambda: table, P, root)
    feats = spark.read.parquet(table).select("sta_num", "features")
    plan = M.score(feats, root, M.model_date_for_training(AS_OF), P)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("labels") <= 1 and plan.count("features#") and sum("features" in line and "Relation" in line for line in plan.splitlines()) == 1


def test_missing_sets_and_horizons_stop_the_forecast(spark, table, tmp_path):
    root = str(tmp_path / "store")
    M.fit_models(spark, lambda: table, P, root)
    date = M.model_date_for_training(AS_OF)
    with pytest.raises(M.MissingModel, match="horizon"):
        M.nodes(spark, root, date, P.with_(fr_len=4))
    with pytest.raises(M.MissingModel, match="committed"):
        M.nodes(spark, root, date - dt.timedelta(days=7), P)
    assert exists(spark, M.date_path(root, date))
