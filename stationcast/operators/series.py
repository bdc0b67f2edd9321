"""Class filters (F1, F2), freshness (F3) and the longest-history dedupe (A1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Params

# Spellings of the base class (self-operated delivery, normal orders) besides the English names.
BASE_DELIVER_ALIASES = ("自营",)
BASE_ORD_ALIASES = ("普通",)


def is_base(p: Params) -> Column:
    d = F.col("deliver_type").isin(p.base_deliver, *BASE_DELIVER_ALIASES)
    o = F.col("ord_type").isin(p.base_ord, *BASE_ORD_ALIASES)
    return F.coalesce(d & o, F.lit(False))


def normalised(df: DataFrame) -> DataFrame:
    """Class names in one spelling: aliases of the base class become its English names, so a station has one base key."""
    def name(col, aliases, english):
        return F.when(F.col(col).isin(*aliases), F.lit(english)).otherwise(F.col(col))

    return (df.withColumn("deliver_type", name("deliver_type", BASE_DELIVER_ALIASES, "Self"))
            .withColumn("ord_type", name("ord_type", BASE_ORD_ALIASES, "Normal")))


def known_at(df: DataFrame, p: Params) -> DataFrame:
    """Histories cut to the days before the as-of day; series that start later are dropped. A back-test then sees what the
    job would have seen."""
    days = F.datediff(F.lit(p.as_of), "start_date")
    return df.where(F.col("start_date") < F.lit(p.as_of)).withColumn("qty", F.slice("qty", 1, days))


def base_class(df: DataFrame, p: Params) -> DataFrame:
    return df.where(is_base(p))


def other_classes(df: DataFrame, p: Params) -> DataFrame:
    return df.where(~is_base(p))


def missing_days(p: Params) -> Column:
    """Days between the series end and yesterday, counted as ``datediff(T-1, start) - size``."""
    return F.datediff(F.lit(p.yesterday), "start_date") - F.size("qty")


def fresh(df: DataFrame, p: Params) -> DataFrame:
    """Drop stale series: more than ``stale_days`` days missing before yesterday."""
    return df.where(missing_days(p) <= p.stale_days)


def dedupe_longest(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the longest history, then the latest start, then a 64-bit hash of the whole row (the
    same pick on every run, whatever the partitioning).

    ``max_by`` is aggregated partially on each map partition, so a key repeated across a third of the input
    ships one row per partition into the shuffle, never the whole group. The ordering key is three scalars, so
    the shuffled buffer holds the history once (a key made of the row itself would carry it twice).
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.size("qty"), F.col("start_date"), F.xxhash64(*[F.col(c) for c in rest]))
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"))
            .select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
            .select(*df.columns))
