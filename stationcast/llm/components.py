"""Connected components of links between 64-bit ids: union-find inside partitions, star contraction between them.

Every round keeps at most as many links as there were; a hub is aggregated partially before each shuffle, and its links
are split over tasks in the joins (adaptive skew handling). Rounds are written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a partition's links: its nodes, each linked to the least node of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, r) for x in parent if (r := root(x)) != x]
    for i in range(0, len(pairs), 65536):
        part = pairs[i:i + 65536]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part], pa.int64()) for k in (0, 1)], names=["u", "v"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (u, v)``: the least node reachable. No row for unlinked nodes."""
    now = written(links.select(F.col("u").cast("long"), F.col("v").cast("long")).where(F.col("u") != F.col("v"))
                  .mapInArrow(_forest, "u long, v long"), "links")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or not row[0]:
            break
        mark = tuple(row)
        now = written(_small_star(_large_star(now)), "links")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
