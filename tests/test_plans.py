"""Physical-plan properties that matter at scale: pruning, pushdown, partial aggregation, no Python in the hot
path, no Cartesian products, bounded broadcasts; and hot keys holding a third of the rows."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import days, make_ref, make_series, series_row

import __spark_entry__ as entry
from stationcast.operators import features, series as ser
from stationcast.operators.joins import estimated_bytes, sized_broadcast
from stationcast.plans import forecast_job as fj
from stationcast.plans import queries as q

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_lineitem_scan_is_pruned(spark):
    text = _formatted(q.s1_series_meta(spark, SF))
    block = [b for b in text.split("\n\n") if b.lstrip().startswith("(") and "Scan parquet" in b
             and "lineitem.parquet" in b][0]
    assert ("ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string,l_linestatus:string,"
            "l_shipdate:timestamp_ntz>") in block
    pushed = [ln for ln in block.splitlines() if ln.startswith("PushedFilters")][0]
    assert "IsNotNull(l_suppkey)" in pushed


@pytest.mark.parametrize("name", ["s1_series", "j1_class_ratio", "w4_features", "j5_training_set", "r2_allocate",
                                  "r4_report_blocks", "r6_report", "w8_actuals"])
def test_no_python_or_cartesian_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_dedupe_aggregates_before_the_shuffle(spark, p):
    # one key holds a third of the rows (copies of one series): partial max_by collapses them map-side
    hot = [series_row(sta="1", qty=[1] * (400 + i % 7), start=days(400 + i % 7)) for i in range(60)]
    rest = [series_row(sta=str(k), qty=[k] * 300, start=days(300)) for k in range(2, 122)]
    df = make_series(spark, hot + rest).repartition(6)
    out = ser.dedupe_longest(df, ["sta_num", "deliver_type", "ord_type"])
    plan = _plan(out)
    # an aggregate below the exchange (listed after it): the partial max_by runs before the shuffle
    below = plan[plan.index("Exchange"):]
    assert "SortAggregate" in below or "HashAggregate" in below
    rows = {r.sta_num: r for r in out.collect()}
    assert len(rows) == 121 and len(rows["1"].qty) == 406


def test_hot_city_features(spark, p):
    # a third of the stations share one city: the reference is joined per series, results stay whole
    rows = [series_row(sta=str(k), start=days(500), qty=[1 + (i * 7 + k) % 5 for i in range(499)],
                       city="1" if k % 3 == 0 else str(k)) for k in range(90)]
    ref = make_ref(spark, [("1", "0", [1 + (i * 7) % 5 for i in range(500)], days(500))])
    got = features.forecast_features(make_series(spark, rows), ref, p, measured=True)
    assert got.count() == 90


def test_window_and_forecast_join_share_the_station_partitioning(spark, p):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = fj.clean_series(make_series(spark, [series_row(sta=str(k)) for k in range(10)]), p)
        fc = spark.createDataFrame([(str(k), [1.0] * 35) for k in range(10)], "sta_num string, forecast array<double>")
        plan = _plan(fj.allocated(clean, fc, p))
        assert "BroadcastExchange" not in plan
        # one exchange for the window (series side) and one for the forecast side, none more
        assert plan.count("Exchange hashpartitioning(sta_num") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sized_broadcast_measures(spark):
    small = spark.createDataFrame([("1", [1, 2, 3])], "k string, a array<bigint>")
    assert estimated_bytes(small, ("a",)) == 64 + 24
    assert sized_broadcast(small, ("a",), limit=10) is small
    assert sized_broadcast(small, ("a",), limit=1000) is not small


@pytest.mark.parametrize("name", ["w4_features", "j5_training_set"])
def test_feature_arrays_computed_once(spark, name):
    """The window cleaning (``array_sort`` of inliers) sits in one plan node: no filter is pushed below it
    with the feature expression copied in (plain filters and generator-inferred filters both would)."""
    text = _formatted(entry.queries()[name](spark, SF))
    nodes = [b for b in text.split("\n\n") if b.lstrip().startswith("(") and "array_sort(" in b]
    assert len(nodes) == 1, [n.strip().splitlines()[0] for n in nodes]
