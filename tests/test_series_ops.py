"""F1-F3, A1, P4-P6 on hand-written rows (FIXTURES section 2)."""

from __future__ import annotations

from conftest import days, make_series, series_row

from stationcast.operators import series as ser
from stationcast.sources import codes


def test_freshness_limit(spark, p):
    # last recorded day T-92 -> missing = 90 -> kept; last day T-93 -> 91 -> dropped
    rows = [series_row(sta="1", start=days(500), qty=[1] * 409),
            series_row(sta="2", start=days(500), qty=[1] * 408)]
    got = {r.sta_num for r in ser.fresh(make_series(spark, rows), p).collect()}
    assert got == {"1"}


def test_dedupe_keeps_longest_and_is_deterministic(spark, p):
    rows = [series_row(sta="1", qty=[1] * 400, start=days(400)), series_row(sta="1", qty=[2] * 410, start=days(410)),
            series_row(sta="2", qty=[1] * 10, start=days(10), remark="a"),
            series_row(sta="2", qty=[1] * 10, start=days(10), remark="b")]
    df = make_series(spark, rows)
    out = {r.sta_num: r for r in ser.dedupe_longest(df, ["sta_num", "deliver_type", "ord_type"]).collect()}
    assert len(out["1"].qty) == 410
    again = ser.dedupe_longest(df.repartition(3), ["sta_num", "deliver_type", "ord_type"]).collect()
    assert {r.sta_num: r.remark for r in again}["2"] == out["2"].remark


def test_base_and_other_classes(spark, p):
    rows = [series_row(sta="1"), series_row(sta="1", deliver="FBP"), series_row(sta="1", ord_="Fresh1"),
            series_row(sta="2", deliver="自营", ord_="普通")]
    df = make_series(spark, rows)
    assert ser.base_class(df, p).count() == 2
    assert ser.other_classes(df, p).count() == 2


def test_codes_and_unknown_names(spark):
    rows = [series_row(sta="1"), series_row(sta="2", deliver="Drone", region="Atlantis")]
    df = make_series(spark, rows)
    dim = codes.code_dim(spark)
    df = codes.encode(df, dim, "deliver", "deliver_type", "fr_type")
    df = codes.encode(df, dim, "region", "region_name", "region_id")
    out = {r.sta_num: r for r in df.withColumn("q", codes.quarantined(df, ["fr_type", "region_id"])).collect()}
    assert (out["1"].fr_type, out["1"].region_id, out["1"].q) == ("2", "1", False)
    assert out["2"].fr_type is None and out["2"].q is True
