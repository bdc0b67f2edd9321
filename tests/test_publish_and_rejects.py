"""Lines that cannot be read, reports that fail, what jobs leave behind."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from conftest import days, make_ref, make_series, series_row
from pyspark.sql import functions as F

from stationcast import session
from stationcast.functions import dates
from stationcast.operators import report
from stationcast.params import GbtParams
from stationcast.plans import cli, forecast_job as fj, train_job as tj
from stationcast.sources import codes, series_text


def good_lines(spark, n: int = 3) -> list[str]:
    rows = [series_row(sta=str(i), start=days(500), qty=[1, None, 3]) for i in range(n)]
    return [r.value for r in series_text.series_text(make_series(spark, rows)).collect()]


def test_lines_that_cannot_be_read_are_rejected_counted_and_the_others_read(spark, tmp_path):
    good = good_lines(spark)
    fields = good[0].split("\x01")
    bad = {"blank": ["", "   "], "fields": [good[0][:20], "x", good[1] + "\x01more"],
           "row key": ["\x01".join([fields[0], fields[1] + "$", *fields[2:]])],
           "start date": ["\x01".join([*fields[:3], d, *fields[4:]]) for d in ("2001-13-40", "", "yesterday")]}
    lines = spark.createDataFrame([(x,) for x in good + sum(bad.values(), [])], "value string")
    read = series_text.parse_series(lines).collect()
    assert sorted(r.sta_num for r in read) == ["0", "1", "2"] and all(r.qty == [1, None, 3] and r.start_date == days(500) for r in read)
    path = str(tmp_path / "rejects")
    assert series_text.write_rejects(lines, path, 9) == {k: len(v) for k, v in bad.items()}
    kept = {(r["value"], r["reason"]) for r in spark.read.parquet(path).collect()}
    assert kept == {(x, k) for k, v in bad.items() for x in v}
    with pytest.raises(series_text.TooManyRejects, match="9 lines"):
        series_text.write_rejects(lines, path, 8)
    assert spark.read.parquet(path).count() == 9


def test_city_lines_that_cannot_be_read(spark, tmp_path):
    lines = spark.createDataFrame([("7#1#1, 2#2001-01-01",), ("7#1",), ("",), ("7#2#1#never",)], "value string")
    assert [r.city_id for r in series_text.parse_city_reference(lines).collect()] == ["1"]
    assert series_text.write_rejects(lines, str(tmp_path / "r"), 5, "city") == {"fields": 1, "blank": 1, "start date": 1}


def test_command_line_stops_over_its_limit_of_rejects(spark, p, tmp_path):
    root = f"{tmp_path}/series/source_type={p.train_source}/date_type=day"
    spark.createDataFrame([(x,) for x in [*good_lines(spark), "broken", "broken too"]], "value string").write.text(root)
    spark.createDataFrame([("7#1#1, 2#2001-01-01",)], "value string").write.text(f"{tmp_path}/cref")
    args = ["train", "--as-of", p.as_of.isoformat(), "--series", f"{tmp_path}/series", "--city-ref", f"{tmp_path}/cref", "--models", f"{tmp_path}/m",
            "--rejects", f"{tmp_path}/rejects", "--max-rejects", "1"]
    with pytest.raises(series_text.TooManyRejects):
        cli.main(args)
    assert spark.read.parquet(f"{tmp_path}/rejects/train-{p.as_of.isoformat()}/series").count() == 2


def report_of(spark, p, stations: int, fails: bool = False):
    rows = make_series(spark, [series_row(sta=str(i), start=days(500), region="North" if i else "Nowhere") for i in range(stations)])
    rows = rows.withColumn("forecast", F.array(*[F.lit(1.0)] * p.fr_len))
    if fails:
        rows = rows.withColumn("sta_name", F.when(F.col("sta_num") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("sta_name")))
    return report.report_rows(rows, codes.code_dim(spark), p)


def test_a_report_that_fails_leaves_the_old_one_and_counts_come_from_the_same_run(spark, p, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    monkeypatch.setattr(report, "quarantined_rows", None)           # nothing counts in a second run
    first = report.publish(report_of(spark, p, 3), root, p, files=2)
    assert first[1:] == (3, 1)
    with pytest.raises(Exception, match="lost"):
        report.publish(report_of(spark, p, 5, fails=True), root, p)
    assert spark.read.text(first.path).count() == 3
    again = report.publish(report_of(spark, p, 4), root, p)
    assert again == (first.path, 4, 1) and spark.read.text(first.path).count() == 4
    assert os.listdir(root) == [p.as_of.isoformat()]


def test_jobs_leave_nothing_in_the_shared_folder(spark, p, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr(session, "shared_dir", lambda spark, *parts: os.path.join(shared, *parts, uuid.uuid4().hex))
    qty = [1 + (i * 7) % 5 for i in range(499)]
    s = make_series(spark, [series_row(sta=str(k), start=days(500), qty=[q + k for q in qty]) for k in range(3)])
    ref = make_ref(spark, [("1", "1", [*qty, 1], days(500))])
    small = p.with_(fr_len=2, gbt=GbtParams(max_iter=2, max_depth=2))
    left = lambda: [f for _, _, files in os.walk(shared) for f in files]
    tj.run(spark, s, ref, small.with_(as_of=p.as_of - dt.timedelta(days=7)), str(tmp_path / "m"))
    assert left() == []
    done = fj.run_and_publish(spark, s, ref, codes.code_dim(spark), small, str(tmp_path / "m"), str(tmp_path / "out"))
    assert (done.lines, done.unknown) == (3, 0) and left() == []
    with pytest.raises(Exception, match="committed"):
        fj.run_and_publish(spark, s, ref, codes.code_dim(spark), small.with_(as_of=p.as_of + dt.timedelta(days=21)), str(tmp_path / "m"), str(tmp_path / "out"))
    assert left() == []


def test_model_days_of_a_column_equal_those_of_a_date(spark):
    run_days = [dt.date(2001, 11, 1) + dt.timedelta(days=k) for k in range(21)]
    got = spark.createDataFrame([(d,) for d in run_days], "d date").select("d", dates.training_day(F.col("d")), dates.forecast_day(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(d, dates.model_date_for_training(d), dates.model_date_for_forecast(d)) for d in run_days]
