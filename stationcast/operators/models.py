"""Training and scoring of the per-horizon models (M3-M6, S7, S8, A11) and the model store with its commit.

A store holds, for each model date, attempts and manifests::

    <root>/model_date=2024-03-10/attempt=<name>/nodes/horizon=0/…     the trees as a table of nodes
    <root>/model_date=2024-03-10/attempt=<name>/round=00100/…         rows and trees of a training that goes on
    <root>/model_date=2024-03-10/manifest-00001.json                  a committed set of models

A training writes its state every ``chunk_rounds`` rounds, and again under the same attempt name it goes on from the last one. The
manifest (attempt, rows and nodes of each horizon, settings) is written last, as a whole. Scoring reads the newest manifest and only what
it names, so a training that breaks off leaves the models as they were.

Scoring reads the features once: blocks of feature rows meet slices of the node table, and a station's partial sums (one number per
horizon) are added up. There are as many blocks as the rows fill, so the nodes are copied once per ``BLOCK_ROWS`` rows, whatever the
number of shuffle partitions.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import model_date_for_forecast, model_date_for_training
from ..params import GbtParams, Params
from ..session import exists, names_in, read_text, release, write_text
from . import boosting as B
from .training import horizon_filter

NODE_COLUMNS = "tree int, node int, feature int, bin int, cut double, value double"
BLOCK_ROWS = 4096
SLICE_NODES = 1 << 18


class MissingModel(RuntimeError):
    """A set of models that the forecast needs is not in the store."""


# ---- the store -----------------------------------------------------------------------------------------------------------

def date_path(root: str, model_date: dt.date) -> str:
    return f"{root.rstrip('/')}/model_date={model_date.isoformat()}"


def manifest(spark: SparkSession, root: str, model_date: dt.date) -> dict:
    """The newest committed set of a model date."""
    folder = date_path(root, model_date)
    found = [n for n in names_in(spark, folder) if n.startswith("manifest-")]
    if not found:
        raise MissingModel(f"no committed models for {model_date} in {folder}")
    return json.loads(read_text(spark, f"{folder}/{found[-1]}"))


def commit(spark: SparkSession, root: str, model_date: dt.date, content: dict) -> None:
    """Makes a set of models the one that is read; the sets before it stay until ``drop_old``."""
    folder = date_path(root, model_date)
    last = max([int(n[9:14]) for n in names_in(spark, folder) if n.startswith("manifest-")], default=0)
    write_text(spark, f"{folder}/manifest-{last + 1:05d}.json", json.dumps(content, indent=1))


def drop_old(spark: SparkSession, root: str, model_date: dt.date) -> None:
    """Deletes the attempts that the newest manifest does not name and the manifests before it. Not while a training runs."""
    folder, now = date_path(root, model_date), manifest(spark, root, model_date)
    kept = [n for n in names_in(spark, folder) if n.startswith("manifest-")][-1]
    for name in names_in(spark, folder):
        if name not in (kept, f"attempt={now['attempt']}"):
            release(spark, f"{folder}/{name}")


def nodes(spark: SparkSession, root: str, model_date: dt.date, p: Params) -> DataFrame:
    """``horizon, tree, node, feature, bin, cut, value`` of the committed set; a horizon that it lacks stops the job."""
    found = manifest(spark, root, model_date)
    missing = [h for h in range(p.fr_len) if str(h) not in found["horizons"]]
    if missing:
        raise MissingModel(f"the models of {model_date} have no horizon {missing}")
    path = f"{date_path(root, model_date)}/attempt={found['attempt']}/nodes"
    if not exists(spark, path):
        raise MissingModel(f"the manifest of {model_date} names {path}, which is not there")
    rows = spark.read.schema(NODE_COLUMNS + ", horizon int").parquet(path)
    return rows.where(F.col("horizon") < p.fr_len)


# ---- training --------------------------------------------------------------------------------------------------------------

def _settings(p: Params) -> dict:
    return {"as_of": p.as_of.isoformat(), "fr_len": p.fr_len, **dataclasses.asdict(p.gbt)}


def _states(spark: SparkSession, folder: str) -> list[str]:
    """The rounds whose state is complete, ascending."""
    return [n for n in names_in(spark, folder) if n.startswith("round=") and exists(spark, f"{folder}/{n}/_SUCCESS")]


def _train(spark: SparkSession, folder: str, cuts: list[list[float]], counts: dict[int, int], p: Params) -> None:
    """Rounds from the last written state on; a state holds all rows with their predictions, and the trees since the one before."""
    g = p.gbt
    large = {h: n for h, n in counts.items() if n > g.group_rows}

    def state() -> tuple[int, DataFrame]:
        last = _states(spark, folder)[-1]
        return int(last[6:]), spark.read.schema(B.STATE).parquet(f"{folder}/{last}").where(F.col("kind") == B.ROW)

    done, rows = state()
    while done < g.max_iter:
        step = 1 if large else min(g.chunk_rounds - done % g.chunk_rounds, g.max_iter - done)
        small = rows.where(~F.col("horizon").isin(list(large))) if large else rows
        # one horizon to a task: the planner must not merge what is small in bytes and long in work
        made = small.repartitionByRange(p.fr_len, "horizon").groupBy("horizon").applyInArrow(B.chunk(done, step, cuts, g), B.STATE)
        if large:
            made = made.unionByName(B.large_round(rows.where(F.col("horizon").isin(list(large))), large, done, cuts, g))
        made.write.mode("overwrite").parquet(f"{folder}/round={done + step:05d}")
        done, rows = state()


def fit_models(spark: SparkSession, table: Callable[[], str], p: Params, root: str, attempt: str | None = None) -> dict:
    """Trains the ``fr_len`` models, commits them under this week's Sunday (M5) and returns the manifest.

    ``table`` makes the feature table of ``train_job`` and returns its path; it is called only if ``attempt`` names no training that
    goes on. A horizon without rows stops the job before anything is written to the store.
    """
    model_date = model_date_for_training(p.as_of)
    attempt = attempt or uuid.uuid4().hex
    folder = f"{date_path(root, model_date)}/attempt={attempt}"
    if exists(spark, f"{folder}/settings.json"):
        begun = json.loads(read_text(spark, f"{folder}/settings.json"))
        if begun["settings"] != _settings(p):
            raise ValueError(f"attempt {attempt} was begun with other settings")
    else:
        rows = spark.read.parquet(table())
        count = rows.agg(*[F.count(F.when(horizon_filter(h, p), F.lit(1))).alias(f"h{h}") for h in range(p.fr_len)]).first()
        empty = [h for h in range(p.fr_len) if not count[f"h{h}"]]
        if empty:
            raise ValueError(f"no training rows for horizons {empty}")
        cuts = B.feature_cuts(rows, p.gbt)
        B.binned_rows(rows, cuts, p).write.mode("overwrite").parquet(f"{folder}/round=00000")
        begun = {"settings": _settings(p), "rows": [count[f"h{h}"] for h in range(p.fr_len)], "cuts": cuts}
        write_text(spark, f"{folder}/settings.json", json.dumps(begun))
    _train(spark, folder, begun["cuts"], dict(enumerate(begun["rows"])), p)

    states = _states(spark, folder)
    trees = spark.read.schema(B.STATE).parquet(*[f"{folder}/{n}" for n in states[1:]] or [f"{folder}/{states[0]}"]).where(F.col("kind") == B.NODE)
    trees = trees.select("horizon", *[c.split()[0] for c in NODE_COLUMNS.split(", ")])
    trees.repartition("horizon").sortWithinPartitions("horizon", "tree", "node").write.mode("overwrite").partitionBy("horizon").parquet(f"{folder}/nodes")
    stored = spark.read.schema(NODE_COLUMNS + ", horizon int").parquet(f"{folder}/nodes")
    size = {r["horizon"]: r for r in stored.groupBy("horizon").agg(F.countDistinct("tree").alias("trees"), F.count(F.lit(1)).alias("nodes")).collect()}
    content = {"attempt": attempt, "settings": begun["settings"], "horizons": {
        str(h): {"path": f"attempt={attempt}/nodes/horizon={h}", "rows": n, "trees": size[h]["trees"], "nodes": size[h]["nodes"]}
        for h, n in enumerate(begun["rows"])}}
    commit(spark, root, model_date, content)
    for name in states:
        release(spark, f"{folder}/{name}")
    return content


# ---- scoring ---------------------------------------------------------------------------------------------------------------

def _sums(fr_len: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a block of feature rows and a slice of nodes, per row and horizon the sum of its leaves in the slice's trees."""
    def run(rows: pa.Table, part: pa.Table) -> pa.Table:
        out = np.zeros((len(rows), fr_len))
        if len(rows) and len(part):
            x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
            h, tree, node, feature, cut, value = (part[c].to_numpy() for c in ("horizon", "tree", "node", "feature", "cut", "value"))
            for horizon in np.unique(h):
                mine = np.flatnonzero(h == horizon)
                key = (tree[mine].astype(np.int64) << 32) + node[mine]
                mine, key = mine[np.argsort(key)], np.sort(key)
                left = np.searchsorted(key, (tree[mine].astype(np.int64) << 32) + 2 * node[mine])     # the child on the right follows
                roots = np.flatnonzero(node[mine] == 1)
                single = feature[mine[roots]] < 0
                out[:, horizon] += value[mine[roots[single]]].sum()
                for lo in range(0, (~single).sum(), 64):                  # trees at a time
                    at = np.tile(roots[~single][lo:lo + 64], (len(rows), 1))
                    live = np.nonzero(feature[mine[at]] >= 0)
                    while len(live[0]):
                        here = at[live]
                        n = mine[here]
                        at[live] = left[here] + (x[live[0], feature[n]] > cut[n])
                        on = feature[mine[at[live]]] >= 0
                        live = (live[0][on], live[1][on])
                    out[:, horizon] += value[mine[at]].sum(axis=1)
        return pa.table({"sta_num": rows["sta_num"], "sums": pa.array(list(out), pa.list_(pa.float64()))})

    return run


def score(features: DataFrame, model_root: str, model_date: dt.date, p: Params) -> DataFrame:
    """``(sta_num, forecast)``: one prediction per horizon, in horizon order (M4, A11). The features are scanned once."""
    model = nodes(features.sparkSession, model_root, model_date, p)
    size = model.groupBy("horizon", "tree").agg(F.count(F.lit(1)).alias("n"))            # horizons x rounds rows
    upto = F.sum("n").over(Window.orderBy("horizon", "tree").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slices = size.select("horizon", "tree", F.floor((upto - F.col("n")) / SLICE_NODES).cast("int").alias("slice"))
    total = sum(h["nodes"] for h in manifest(features.sparkSession, model_root, model_date)["horizons"].values())
    n_slices = total // SLICE_NODES + 1
    n_blocks = max(1, -(-features.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("sta_num"), F.lit(n_blocks)).cast("int")

    rows = (features.select("sta_num", vector_to_array("features").alias("x")).withColumn("block", block)
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)))))
    trees = model.join(slices, ["horizon", "tree"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    parts = (rows.groupBy("block", "slice").cogroup(trees.groupBy("block", "slice"))
             .applyInArrow(_sums(p.fr_len), T.StructType([T.StructField("sta_num", features.schema["sta_num"].dataType),
                                                          T.StructField("sums", T.ArrayType(T.DoubleType()))])))
    added = parts.groupBy("sta_num").agg(*[F.sum(F.col("sums")[h]).alias(f"h{h}") for h in range(p.fr_len)])
    return added.select("sta_num", F.array(*[F.col(f"h{h}") + F.lit(p.gbt.base_score) for h in range(p.fr_len)]).alias("forecast"))


def forecast_model_date(p: Params) -> dt.date:
    return model_date_for_forecast(p.as_of)


__all__ = ["GbtParams", "MissingModel", "commit", "date_path", "drop_old", "fit_models", "forecast_model_date", "manifest", "nodes", "score"]
