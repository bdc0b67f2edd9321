"""Join helpers: broadcast only behind a measured size, otherwise a shuffle join, salted where a key is heavy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW_OVERHEAD = 64  # bytes per row besides array payloads, a generous estimate for a few short columns


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold (``spark.sql.autoBroadcastJoinThreshold``); 0 when broadcasting is
    switched off (a negative setting)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    num = raw.rstrip("bkmg")
    unit = raw[len(num):] or "b"
    try:
        v = int(float(num) * _UNITS.get(unit, 1))
    except ValueError:
        v = 10 << 20
    return max(v, 0)


def estimated_bytes(df: DataFrame, array_cols: tuple[str, ...] = (), elem_bytes: int = 8) -> int:
    """One aggregate job: row count and array lengths of ``df`` turned into a byte estimate."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(F.size(c)).alias(f"s{i}") for i, c in enumerate(array_cols)]
    row = df.agg(*aggs).first()
    n = row["n"] or 0
    payload = sum((row[f"s{i}"] or 0) for i in range(len(array_cols)))
    return n * _ROW_OVERHEAD + payload * elem_bytes


def sized_broadcast(df: DataFrame, array_cols: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size is under ``limit``, else ``df`` unchanged (shuffle join).

    Call it on a materialised (checkpointed) or cheap frame: the measurement is a job over ``df``.
    """
    lim = broadcast_limit(df.sparkSession) if limit is None else limit
    if lim <= 0:
        return df
    return F.broadcast(df) if estimated_bytes(df, array_cols) <= lim else df


#: A key with more rows than this is heavy.
HEAVY_ROWS = 1_000_000
#: At most so many keys can be heavy, whatever the input: the threshold rises with the number of rows.
MAX_HEAVY = 10_000
NULL_PARTS = 1024


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``(key, parts)`` of the keys with more than ``heavy_rows`` rows: counts over all of ``df``, aggregated before their shuffle.
    ``parts`` says into how many parts of about ``heavy_rows`` rows the key is cut. Fewer than ``MAX_HEAVY`` rows come back, because a key
    is heavy only above the ``MAX_HEAVY``-th part of all rows; so the result may be broadcast."""
    least = max(heavy_rows, df.count() // MAX_HEAVY)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > least).select(key, F.ceil(F.col("_rows") / F.lit(least)).cast("int").alias("_parts"))


def lookup(df: DataFrame, dim: DataFrame, key: str, spread: str, array_cols: tuple[str, ...] = (), heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``df`` left-joined with ``dim`` (one row per ``key``): broadcast if ``dim`` is measured to be small enough, else a shuffle join in
    which heavy keys are salted.

    A row of a heavy key goes to one of the key's parts by the hash of its column ``spread`` (the same part when a lost task runs again),
    and the ``dim`` row of that key is copied to each part, so every row still meets its ``dim`` row exactly once. Rows without a key meet
    nothing and are dealt over ``NULL_PARTS`` parts. Both tables are read more than once: pass written ones.
    """
    small = sized_broadcast(dim, array_cols)
    if small is not dim:
        return df.join(small, key, "left")
    heavy = F.broadcast(heavy_keys(df.select(key), key, heavy_rows))
    part = F.when(F.col(key).isNull(), F.lit(NULL_PARTS)).otherwise(F.coalesce(F.col("_parts"), F.lit(1)))
    left = df.join(heavy, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread), part).cast("int")).drop("_parts")
    right = (dim.join(heavy, key, "left")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts"))
    return left.join(right, [key, "_part"], "left").drop("_part")
