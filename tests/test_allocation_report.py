"""A2, A9, J1, R1-R7, W9-W13 on hand-written rows (FIXTURES section 2)."""

from __future__ import annotations

import datetime as dt

from conftest import days, make_series, series_row
from pyspark.sql import functions as F

from stationcast.operators import allocation, report
from stationcast.plans import forecast_job as fj
from stationcast.sources import codes


def _fc(spark, rows):
    return spark.createDataFrame(rows, "sta_num string, forecast array<double>")


def test_class_ratio_and_zero_base(spark, p):
    rows = [series_row(sta="1", qty=[2] * 499), series_row(sta="1", deliver="FBP", qty=[1] * 499),
            series_row(sta="2", qty=[0] * 499), series_row(sta="2", deliver="FBP", qty=[1] * 499),
            series_row(sta="3", deliver="FBP", qty=[1] * 499)]
    r = {x.sta_num: x for x in allocation.class_ratio(make_series(spark, rows), p).collect()}
    assert r["1"].ratio == 0.5 and (r["1"].sum60, r["1"].base60) == (60, 120)
    assert r["2"].ratio == 1.0          # base sold nothing: ratio 1 (as published)
    assert "3" not in r                 # no base row at the station


def test_allocation_factor_and_cap(spark, p):
    rows = [series_row(sta="1", qty=[2] * 499), series_row(sta="1", deliver="FBP", qty=[1] * 499),
            series_row(sta="2", qty=[0] * 499), series_row(sta="2", deliver="FBP", qty=[1] * 499),
            series_row(sta="3", qty=[1] * 499), series_row(sta="3", deliver="3rd", qty=[1] * 499),
            series_row(sta="4", qty=[10] * 499), series_row(sta="4", deliver="FBP", qty=[0] * 469 + [10] * 30),
            series_row(sta="5", deliver="FBP", qty=[1] * 499)]
    fc = _fc(spark, [("1", [4.0] * 35), ("2", [4.0] * 35), ("3", [1.0] * 35), ("4", [40.0] * 35)])
    out = {(r.sta_num, r.deliver_type): r.forecast for r in fj.allocated(make_series(spark, rows), fc, p).collect()}
    assert out[("1", "Self")] == [4.0] * 35
    assert out[("1", "FBP")] == [2.0] * 35                # ratio 0.5
    assert out[("2", "FBP")] == [0.0] * 35                # base sum 0 -> allocation 0
    assert out[("3", "3rd")] == [1.0] * 35                # genuine ratio 1.0 is kept by default
    # station 4: ratio 300/600 = 0.5 -> 20/day = 700 > 2 * 300 (last 35 days) -> flat 300/35
    assert out[("4", "FBP")] == [300.0 / 35] * 35
    assert out[("5", "FBP")] is None                      # no base row at the station: no forecast
    legacy = {(r.sta_num, r.deliver_type): r.forecast
              for r in fj.allocated(make_series(spark, rows), fc, p.with_(ratio_one_is_zero=True)).collect()}
    assert legacy[("3", "3rd")] == [0.0] * 35


def _report(spark, p, rows, fc_rows):
    return {(r.sta_num, r.deliver_name): r for r in
            fj.build_report(make_series(spark, rows), _fc(spark, fc_rows), codes.code_dim(spark), p).collect()}


def test_report_young_series(spark, p):
    rows = [series_row(sta="5", start=days(5), qty=[1, 2, 3, 4, 5]),
            series_row(sta="365", start=days(365), qty=[1] * 365)]
    out = _report(spark, p, rows, [("5", [float(i) for i in range(35)])])
    r5 = out[("5", "Self")]
    assert r5.current_block.recent == [1, 2, 3, 4, 5]
    assert r5.current_block.forecast == [float(i) for i in range(28)]
    assert r5.current_block.week_rest == [28.0, 29.0, 30.0, 31.0, 32.0, 33.0, 34.0]   # as-of Monday: 7 days
    assert r5.current_block.rolling == [0] * 9
    assert r5.year_ago_block is None
    assert out[("365", "Self")].year_ago_block is None
    assert out[("365", "Self")].current_block.forecast == []      # no forecast for the station
    text = {r.value.split("#")[5]: r.value for r in report.report_text(
        fj.build_report(make_series(spark, rows), _fc(spark, []), codes.code_dim(spark), p)).collect()}
    assert text["5"].split("#")[13] == "$$$"
    assert text["5"].split("#")[7:9] == ["2001-11-04", "2001-11-05"]


def test_report_year_ago_lengths(spark, p):
    rows = [series_row(sta=str(n), start=days(n), qty=list(range(n))) for n in (366, 400, 424)]
    out = _report(spark, p, rows, [])
    for n, k in ((366, 2), (400, 36), (424, 60)):
        ago = out[(str(n), "Self")].year_ago_block
        assert len(ago.recent) == k
        assert len(ago.forecast) == 28 and len(ago.week_rest) == 7


def test_report_rolling_sums(spark, p):
    qty = list(range(100))
    out = _report(spark, p, [series_row(sta="1", start=days(100), qty=qty)], [])
    t = qty[:-10]
    assert out[("1", "Self")].current_block.rolling == list(reversed([sum(t[-i - 7:-i]) for i in range(1, 10)]))


def test_rest_of_week_on_sunday(spark, p):
    sunday = p.with_(as_of=dt.date(2001, 11, 4))
    rows = [series_row(sta="1", start=sunday.as_of - dt.timedelta(days=100), qty=[1] * 99)]
    out = _report(spark, sunday, rows, [("1", [1.0] * 35)])
    assert out[("1", "Self")].current_block.week_rest == [1.0]


def test_report_invariants_on_driver_tables(spark):
    """End to end on sf0.001 with the seasonal-naive base forecast: every fresh series once, 28 + rest-of-week
    forecast values, the cap holds, quarantine empty."""
    from stationcast.plans import queries as q

    p = q.params()
    sf = "/root/testdata/sf0.001"
    clean = fj.clean_series(q._series(spark, sf, p), p)
    rep = fj.build_report(clean, fj.naive_forecasts(clean, p), codes.code_dim(spark, q.tables.region_codes(spark, sf)), p)
    rows = rep.collect()
    keys = [(r.sta_num, r.deliver_name, r.ord_name) for r in rows]
    assert len(keys) == len(set(keys)) == clean.count()
    for r in rows:
        fc = r.current_block.forecast
        assert len(fc) in (0, 28) and len(r.current_block.week_rest) == (p.rest_of_week if fc else 0)
        assert len(r.current_block.recent) == 60 and len(r.current_block.rolling) == 9
    alloc = fj.allocated(clean, fj.naive_forecasts(clean, p), p).where(~F.col("is_base") & F.col("has_base"))
    for r in alloc.select("forecast", F.slice("qty", -35, 35).alias("last")).collect():
        last = float(sum(x or 0 for x in r["last"]))      # an unknown day counts as 0
        flat = all(abs(x - last / 35) < 1e-9 for x in r.forecast)
        assert flat or sum(r.forecast) <= 2 * last + 1e-9
    assert report.quarantined_rows(rep).count() == 0
