"""J3 with cities that hold very many stations: salted lookups against a plain join."""

from __future__ import annotations

import re

import pytest
from conftest import days, make_ref, make_series, series_row
from pyspark.sql import functions as F

from stationcast.operators import features, joins


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stations(spark, n: int = 600):
    """A third of the stations in city 0, a third without a city, the others spread; cities 5 and 6 have no reference."""
    city = F.when(F.col("id") % 3 == 0, F.lit("0")).when(F.col("id") % 3 == 2, F.concat(F.lit(""), F.col("id") % 7))
    return spark.range(n).select(F.col("id").cast("string").alias("sta_num"), city.alias("city_id"))


def cities(spark, rows=5):
    return spark.createDataFrame([(str(i), [i] * 3) for i in range(rows)], "city_id string, ref_qty array<bigint>")


def plain(df, dim):
    ref = {r.city_id: r.ref_qty for r in dim.collect()}
    return sorted((r.sta_num, r.city_id or "", ref.get(r.city_id)) for r in df.collect())


@pytest.mark.parametrize("heavy_rows", [1, 10, 50, 10**6])
def test_salted_lookup_equals_the_plain_join(spark, no_broadcast, heavy_rows):
    df, dim = stations(spark).unionByName(stations(spark, 50)), cities(spark)       # some stations twice
    got = joins.lookup(df, dim, "city_id", "sta_num", ("ref_qty",), heavy_rows)
    assert got.columns == ["city_id", "sta_num", "ref_qty"]
    assert sorted((r.sta_num, r.city_id or "", r.ref_qty) for r in got.collect()) == plain(df, dim)


def test_a_heavy_city_and_rows_without_one_meet_in_many_partitions(spark, no_broadcast):
    df = stations(spark, 3000)
    got = joins.lookup(df, cities(spark), "city_id", "sta_num", ("ref_qty",), heavy_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(city_id#\d+, _part#\d+", plan) and "CartesianProduct" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        where = got.groupBy("city_id", F.spark_partition_id().alias("k")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for city in ("0", None):
        parts = [r["count"] for r in where if r.city_id == city]
        assert len(parts) >= 5 and max(parts) < 1000 / 2
    assert sum(r["count"] for r in where) == 3000


def test_heavy_keys_are_measured_and_bounded(spark, monkeypatch):
    df = stations(spark)
    assert {r.city_id: r._parts for r in joins.heavy_keys(df, "city_id", 100).collect()} == {"0": 3}
    assert joins.heavy_keys(df, "city_id", 1000).count() == 0
    monkeypatch.setattr(joins, "MAX_HEAVY", 3)                                        # over a third of 600 rows, or not heavy
    assert [(r.city_id, r._parts) for r in joins.heavy_keys(df, "city_id", 1).collect()] == [("0", 2)]
    assert joins.heavy_keys(df.limit(0), "city_id").count() == 0


def test_features_do_not_depend_on_the_kind_of_join(spark, p, monkeypatch):
    young = [series_row(str(i), start=days(300), qty=[1, 2, 3, 9] * 75, city="1" if i % 3 else str(i)) for i in range(12)]
    ref = make_ref(spark, [(c, "9", [5, 7, 6, 1 + int(c)] * 150, days(600)) for c in ("1", "3", "6")])
    s = make_series(spark, young)

    def rows():
        return sorted((r.sta_num, r.path, r.hist) for r in features.forecast_features(s, ref, p).collect())

    small = rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins.lookup, "__defaults__", ((), 2))
    try:
        assert rows() == small and len(small) > 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
