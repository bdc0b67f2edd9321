"""Feature rows kept from one training to the next (J5, M2): a weekly retrain shares 55 of its 62 feature days with the one before.

A store is a table ``pre_end=<day>/`` of ``(sta_num, sig, path, values)``: the 93 feature values of a station on a feature day, under
the signature of everything they were computed from (``features.input_signature``). A row is never changed. ``values`` is NULL where
there is no valid history, so such rows are not tried again.

An update computes all rows of the days that the store lacks. Of the other days it compares narrow ``(sta_num, pre_end, sig)`` keys and
computes what is missing: restated quantities, another city reference, stations that are no longer young, files that got lost. So
the result equals a computation from scratch whatever the store holds, and an update that breaks off leaves only rows that stay right.
One update of a store at a time. Repeated series share one stored row and keep their number in ``feature_rows``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..params import Params
from ..session import names_in, release, stored
from .features import id_values, input_signature, valid_history, with_history
from .training import feature_days, horizon_labels, pre_end_days

KEYS = ["sta_num", "pre_end", "sig"]
SCHEMA = "sta_num string, sig bigint, path string, values array<double>, pre_end date"


def days_in(spark: SparkSession, store: str) -> list[dt.date]:
    return [dt.date.fromisoformat(n.removeprefix("pre_end=")) for n in names_in(spark, store) if n.startswith("pre_end=")]


def read_rows(spark: SparkSession, store: str, p: Params) -> DataFrame:
    """The stored rows of the training's feature days; a store that is not there yet has none."""
    if not days_in(spark, store):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(store).where(F.col("pre_end").between(*pre_end_days(p)))


def signed_days(inputs: DataFrame, p: Params) -> DataFrame:
    """``training.feature_days`` of ``training.feature_inputs``, with the signature of each row."""
    return feature_days(inputs, p).withColumn("sig", input_signature(p))


def computed(days: DataFrame, p: Params) -> DataFrame:
    """The rows of a store for signed feature days, one per key."""
    rows = with_history(days, p)
    values = let(F.col("hist"), lambda h: F.when(valid_history(h, p), F.concat(h, id_values())))
    return rows.select("sta_num", "sig", "path", values.alias("values"), "pre_end").dropDuplicates(KEYS)


def update(inputs: DataFrame, wanted: DataFrame, p: Params, store: str, folder: Callable[..., str], files_per_day: int) -> None:
    """Adds what the store lacks of ``wanted``, the ``KEYS`` of ``inputs`` on all feature days."""
    spark = inputs.sparkSession
    lo, hi = pre_end_days(p)
    old = [d for d in days_in(spark, store) if lo <= d <= hi]
    new = [lo + dt.timedelta(days=k) for k in range((hi - lo).days + 1) if lo + dt.timedelta(days=k) not in old]
    parts = []
    if new:
        parts.append(computed(signed_days(inputs, p).where(F.col("pre_end").isin(new)), p))
    if old:
        keys = wanted.where(F.col("pre_end").isin(old)).select(*KEYS).distinct()
        lacking = stored(keys.join(read_rows(spark, store, p).select(*KEYS), KEYS, "left_anti"), folder("lacking_features"))
        if not lacking.isEmpty():
            # whole series move once each, their days do not
            series = inputs.join(lacking.select("sta_num").distinct(), "sta_num", "left_semi")
            again = computed(signed_days(series, p).where(F.col("pre_end").isin(old)), p)
            parts.append(again.join(lacking, KEYS, "left_semi"))
    for rows in parts:
        part = F.pmod(F.xxhash64("sta_num", "sig"), F.lit(files_per_day))
        (rows.withColumn("_part", part).repartition("pre_end", "_part").select(*[c.split()[0] for c in SCHEMA.split(", ")])
         .write.mode("append").partitionBy("pre_end").parquet(store))


def feature_rows(inputs: DataFrame, p: Params, store: str, folder: Callable[..., str], files_per_day: int) -> DataFrame:
    """``training.feature_table`` through the store, which is brought up to date first: the same rows, as often as they occur."""
    # Dealt evenly first: series are small in bytes and long in work, so neither a scan's splits nor what the planner merges by size
    # would keep the tasks busy. A given number of partitions is not merged.
    n = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inputs = stored(inputs.repartition(n), folder("feature_inputs"))
    wanted = stored(signed_days(inputs, p).select(*KEYS, horizon_labels(p).alias("labels")), folder("feature_labels"))
    update(inputs, wanted, p, store, folder, files_per_day)
    rows = wanted.join(read_rows(inputs.sparkSession, store, p).where(F.col("values").isNotNull()), KEYS)
    return rows.select("pre_end", "sta_num", "path", array_to_vector("values").alias("features"), "labels")


def drop_before(spark: SparkSession, store: str, p: Params) -> None:
    """Deletes the days that lie before the training's first feature day."""
    for day in days_in(spark, store):
        if day < pre_end_days(p)[0]:
            release(spark, f"{store.rstrip('/')}/pre_end={day.isoformat()}")
