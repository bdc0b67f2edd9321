"""Shards of near equal bytes with equal texts together: minimax contiguous partition of ordered atomic groups (SQL functions only).

Documents with equal texts form a group, which no shard boundary cuts. A group larger than an even share of what is left is a
shard by itself (at most ``shards - 1`` of them). The others, in the order of their text's SHA-256, are cut into contiguous
runs whose largest is as small as can be:

1. one pass over the texts writes id, size, checksum and group key; groups are aggregated partially, so a group that holds a
   third of all rows is one row per task in the shuffle;
2. each group gets its end on the line of bytes (a running sum within key ranges, on top of the sums of the lower ranges);
3. the smallest feasible capacity lies between the even share and the even share plus the largest group. It is
   searched with ``PROBES`` capacities at a time: all walk greedily along the line, one aggregate per cut looks up the
   last group end within reach of each, and reads only the ends near the probes (pushed down to the sorted table);
4. the cuts are group keys, so a document's shard is an expression of its own key: no join, and no text moves;
5. slots number a shard's rows from 0 in the order of id and key: a range partitioning, a running number inside each
   partition, and counts per partition and shard. Its last sort key is a row number, so even copies of one row spread over tasks.

The driver holds the probes, the cuts and at most ``shards`` large groups.

Defined cases: a NULL text has no bytes and stands with the empty texts (size 1); NULL ids come first in a shard; a repeated row
is one more row of its group; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 8
PROBES = 31
RANGE_DIGITS = 3  # leading hex digits of the group key that name a key range of the running sum


class Plan(NamedTuple):
    """Large groups ``{key: shard}``, the last key of every other shard but the final one, and the capacity found."""

    alone: dict[str, int]
    cuts: list[str]
    capacity: int


def facts(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, gkey`` per row: what the shards need of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("gkey"))


def _alone(groups: DataFrame, total: int, shards: int) -> list[tuple[str, int]]:
    """The groups, largest first, that pass an even share of what the larger ones leave."""
    out: list[tuple[str, int]] = []
    for r in groups.orderBy(F.desc("bytes"), "gkey").limit(shards).collect():
        left = total - sum(b for _, b in out)
        if r["bytes"] * (shards - len(out)) <= left:
            break
        out.append((r["gkey"], r["bytes"]))
    return out


def _line(groups: DataFrame) -> DataFrame:
    """``gkey, upto``: each group's end when the groups stand one after another in key order."""
    part = F.substring("gkey", 1, RANGE_DIGITS)
    ranged = groups.withColumn("part", part)
    sums = ranged.groupBy("part").agg(F.sum("bytes").alias("b"))
    before = sums.select("part", (F.sum("b").over(Window.orderBy("part")) - F.col("b")).alias("before"))  # 16^RANGE_DIGITS rows at most
    inside = ranged.withColumn("inside", F.sum("bytes").over(Window.partitionBy("part").orderBy("gkey")))
    return (inside.join(F.broadcast(before), "part").select("gkey", (F.col("before") + F.col("inside")).alias("upto"))
            .sortWithinPartitions("upto"))


def _reach(line: DataFrame, limits: list[int], largest: int) -> list[int]:
    """For each limit the last group end at or under it (0: none). An end lies within ``largest`` bytes below any limit."""
    near = line.where((F.col("upto") <= max(limits)) & (F.col("upto") > min(limits) - largest))
    row = near.agg(*[F.max(F.when(F.col("upto") <= t, F.col("upto"))).alias(f"t{i}") for i, t in enumerate(limits)]).first()
    return [x or 0 for x in row]


def _walk(line: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> list[list[int]]:
    """The greedy cuts of each capacity: every shard takes whole groups up to it."""
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards - 1):
        limits = [min(total, (c[-1] if c else 0) + cap) for c, cap in zip(cuts, capacities, strict=True)]
        for c, x in zip(cuts, _reach(line, limits, largest), strict=True):
            c.append(x)
    return cuts


def plan(facts: DataFrame, shards: int = SHARDS, probes: int = PROBES) -> Plan:
    """The minimax cuts of ``facts (size, gkey, …)`` into ``shards``; several jobs, nothing of the documents' number on the driver."""
    groups = written(facts.groupBy("gkey").agg(F.sum("size").alias("bytes")), "shard_groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = _alone(groups, total, shards)
    alone = {k: i for i, (k, _) in enumerate(large)}
    rest, left = groups.where(~F.col("gkey").isin(list(alone))) if alone else groups, shards - len(alone)
    own = max((b for _, b in large), default=0)
    total, largest = rest.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    if left == 1 or not total:
        return Plan(alone, [], max(own, total))
    line = written(_line(rest), "shard_line")
    low, high = max(largest, -(-total // left)), -(-total // left) + largest      # high is feasible
    cuts: list[int] | None = None
    while low < high or cuts is None:
        step = max(1, -(-(high - low) // (probes + 1)))
        tried = sorted({min(low + i * step, high) for i in range(probes)} | {high} if cuts is None else
                       {min(low + i * step, high - 1) for i in range(probes)})
        walked = _walk(line, tried, left, total, largest)
        good = [total - w[-1] <= c for w, c in zip(walked, tried, strict=True)]
        at = good.index(True) if True in good else len(tried)
        if at < len(tried):
            high, cuts = tried[at], walked[at]
        low = min(tried[at - 1] + 1, high) if at else low
        if at == 0:
            low = high
    ends = {r["upto"]: r["gkey"] for r in line.where(F.col("upto").isin([c for c in cuts if c])).collect()}
    return Plan(alone, [ends.get(c, "") for c in cuts], max(own, high))


def shard_of(gkey: Column, plan: Plan) -> Column:
    """The shard of a group key: large groups first, then the number of cuts below the key."""
    first = len(plan.alone)
    out = F.lit(first) + sum(((gkey > F.lit(c)).cast("int") for c in plan.cuts), F.lit(0))
    for key, shard in plan.alone.items():
        out = F.when(gkey == F.lit(key), F.lit(shard)).otherwise(out)
    return out.cast("int")


def slotted(rows: DataFrame, shard: str = "shard", order: tuple[str, ...] = ("doc_id", "gkey")) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, … within each shard in the given order, numbered without one task per shard."""
    keys = [shard, *order, "row"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
             .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()).drop("row"))
    kept = written(dealt, "shard_rows")
    parts = kept.groupBy(shard, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))   # shards x partitions rows
    offset = parts.select(shard, "part", (F.sum("n").over(Window.partitionBy(shard).orderBy("part")) - F.col("n") - F.col("first")).alias("offset"))
    return (kept.join(F.broadcast(offset), [shard, "part"])
            .withColumn("slot", (F.col("offset") + F.col("at")).cast("long")).drop("at", "part", "offset"))


def shards(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``."""
    known = written(facts(docs), "shard_facts")
    found = plan(known, n)
    placed = slotted(known.withColumn("shard", shard_of(F.col("gkey"), found)))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, found: Plan) -> DataFrame:
    """``docs`` with the column ``shard`` of a plan, for writing them by shard: no join, no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("shard", shard_of(F.sha2(text, 256), found))
