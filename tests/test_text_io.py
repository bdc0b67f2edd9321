"""Text series and city reference round trips, partition pruning, the published report files."""

from __future__ import annotations

import contextlib
import io
import os
import tempfile

from conftest import days, make_ref, make_series, series_row

from stationcast.plans import forecast_job as fj
from stationcast.sources import codes, series_text
from stationcast.operators import report


def test_series_round_trip_and_pruning(spark, p):
    root = tempfile.mkdtemp(prefix="series-")
    rows = [series_row(sta="1", qty=[1, 0, 4]), series_row(sta="2", deliver="FBP", qty=[5, None, 7])]
    df = make_series(spark, rows)
    series_text.write_series(df, root, "station_ords_sta_dt")
    series_text.write_series(df.where("sta_num = '1'"), root, "station_ords_create_dt", mode="append")
    back = series_text.read_series(spark, root, "station_ords_sta_dt")
    got = {r.sta_num: r for r in back.collect()}
    assert got["1"].qty == [1, 0, 4] and got["2"].qty == [5, None, 7]
    assert got["1"].start_date == days(500) and got["2"].deliver_type == "FBP"
    assert series_text.read_series(spark, root, "station_ords_create_dt").count() == 1
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        back.explain("formatted")
    scan = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert scan and "station_ords_sta_dt" in scan[0]


def test_city_reference_round_trip_first_per_city(spark):
    path = tempfile.mkdtemp(prefix="cref-")
    ref = make_ref(spark, [("1", "20", [1, 2], days(10)), ("1", "3", [9], days(5)), ("2", "7", [4], days(4))])
    series_text.city_reference_text(ref).write.mode("overwrite").text(path)
    got = {r.city_id: r for r in series_text.read_city_reference(spark, path).collect()}
    assert got["1"].std_sta_num == "3" and got["1"].ref_qty == [9] and got["2"].ref_start == days(4)


def test_publish_writes_deflate_text(spark, p):
    out_root = tempfile.mkdtemp(prefix="report-")
    rows = [series_row(sta="1", qty=[1] * 499), series_row(sta="1", deliver="FBP", qty=[1] * 499)]
    rep = fj.build_report(make_series(spark, rows),
                          spark.createDataFrame([("1", [2.0] * 35)], "sta_num string, forecast array<double>"),
                          codes.code_dim(spark), p)
    path = report.publish(rep, out_root, p, files=2).path
    assert path.endswith(p.as_of.isoformat())
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".deflate") for f in files)
    lines = spark.read.text(path).collect()
    assert len(lines) == 2 and all(len(r.value.split("#")) == 15 for r in lines)


def test_cli_train_and_forecast(spark, p):
    """The two jobs from the command line, on text inputs (as submitted in production)."""
    import datetime as dt

    from stationcast.plans import cli

    root = tempfile.mkdtemp(prefix="cli-")
    rows = []
    for sta in range(1, 4):
        qty = [sta + (i * 7 + sta) % 5 for i in range(499)]
        rows.append(series_row(sta=str(sta), start=days(500), qty=qty))
        rows.append(series_row(sta=str(sta), deliver="FBP", start=days(500), qty=[x // 2 for x in qty]))
    df = make_series(spark, rows)
    series_text.write_series(df, f"{root}/series", p.forecast_source)
    series_text.write_series(df, f"{root}/series", p.train_source, mode="append")
    ref = make_ref(spark, [("1", "1", [1 + (i * 7) % 5 for i in range(500)], days(500))])
    series_text.city_reference_text(ref).write.mode("overwrite").text(f"{root}/cref")
    common = ["--series", f"{root}/series", "--city-ref", f"{root}/cref", "--models", f"{root}/models",
              "--max-iter", "2", "--max-depth", "2"]
    cli.main(["train", "--as-of", (p.as_of - dt.timedelta(days=7)).isoformat(), *common])
    cli.main(["forecast", "--as-of", p.as_of.isoformat(), "--out", f"{root}/out", "--files", "1", *common])
    lines = spark.read.text(f"{root}/out/{p.as_of.isoformat()}").collect()
    assert len(lines) == 6
    base = [r.value.split("#") for r in lines if r.value.split("#")[9] == "2"][0]
    assert len(base[12].split("$")[1].split(",")) == 28
