"""Cases that stop or bend a job: unknown days, missing models, late starts, blank ids, large quantities, respelled base classes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import T, days, make_ref, make_series, series_row
from stationcast.functions import arrays
from stationcast.operators import allocation, features, models, report, series as ser
from stationcast.params import Params
from stationcast.plans import forecast_job as fj, queries as q, train_job as tj
from stationcast.sources import codes, series_text, tables


def _forecast(spark, rows):
    return spark.createDataFrame(rows, "sta_num string, forecast array<double>")


def test_unknown_days_keep_their_place_in_the_text(spark, p):
    qty = [1] * 500
    qty[-3] = None
    fc = [float(i) for i in range(35)]
    fc[3] = None
    rep = fj.build_report(make_series(spark, [series_row("1", qty=qty)]), _forecast(spark, [("1", fc)]), codes.code_dim(spark), p)
    line = report.report_text(rep).first()["value"]
    recent, forecast, rest, rolling = line.split("#")[12].split("$")
    assert recent.split(",")[-3] == "\\N" and len(recent.split(",")) == 60
    assert forecast.split(",")[3:5] == ["\\N", "4.0"] and len(forecast.split(",")) == 28
    assert len(rest.split(",")) == p.rest_of_week and len(rolling.split(",")) == 9
    assert rolling.split(",")[-1] == "7"


def test_number_text(spark):
    values = [12.0, 0.5, 10 / 3, 0.0, 1e-7, 123456789.25, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(report.number_text(F.col("x"))).collect()] == [
        "12.0", "0.5", "3.333333", "0.0", "0.0", "123456789.25", "100.0"]


def test_unknown_day_does_not_empty_a_station(spark, p):
    base, other = [2] * 500, [1] * 500
    base[-5] = None
    rows = make_series(spark, [series_row("1", qty=base), series_row("1", qty=other, deliver="FBP")])
    r = allocation.class_ratio(rows, p).first()
    assert (r["sum60"], r["base60"]) == (60, 118)


def test_missing_model_stops_the_job(spark, p, tmp_path):
    feats = spark.createDataFrame([("1", [1.0] * 93)], "sta_num string, h array<double>")
    from pyspark.ml.functions import array_to_vector

    with pytest.raises(models.MissingModel, match="committed"):
        models.score(feats.select("sta_num", array_to_vector("h").alias("features")), str(tmp_path), dt.date(2001, 11, 4), p)


def test_training_without_rows_stops_before_saving(spark, p, tmp_path):
    s = make_series(spark, [series_row("1", qty=[0] * 500)])
    ref = make_ref(spark, [("1", "9", [1] * 500, days(500))])
    with pytest.raises(ValueError, match="no training rows"):
        tj.run(spark, s, ref, p, str(tmp_path / "models"))
    assert not (tmp_path / "models").exists()


def test_series_that_starts_after_the_as_of_day(spark, p):
    late = series_row("2", start=T + dt.timedelta(days=6), qty=[77] * 60)
    ref = make_ref(spark, [("1", "9", [5] * 600, days(550))])
    assert features.forecast_features(make_series(spark, [late]), ref, p).count() == 0
    clean = fj.clean_series(make_series(spark, [late, series_row("1", qty=[1] * 520)]), p, checkpoint=False)
    assert [(r["sta_num"], len(r["qty"])) for r in clean.collect()] == [("1", 500)]     # days from T on are not known yet


def test_blank_id_counts_as_zero(spark, p):
    s = make_series(spark, [series_row("1", qty=[1, 2, 3, 9] * 125, county_id="")])
    f = features.with_feature_vector(features.forecast_features(s, make_ref(spark, [("1", "9", [5] * 600, days(600))]), p))
    assert f.first()["features"][92] == 0.0


def test_large_quantities_are_cleaned_exactly(spark):
    small = [3, 5, 4, 100, 4, 5]
    for scale in (1, 200_000_000, 10**15):
        df = spark.createDataFrame([([x * scale for x in small],)], "w array<bigint>")
        assert df.select(arrays.clean_values(F.col("w"))).first()[0] == [x * scale for x in (3.0, 5.0, 4.0, 4.0, 4.0, 5.0)]


def test_other_window_length(spark):
    p = Params(as_of=T, window_len=28)
    s = make_series(spark, [series_row("1", qty=[1, 2, 3, 9] * 125)])
    f = features.forecast_features(s, make_ref(spark, [("1", "9", [5] * 600, days(600))]), p).first()
    assert len(f["hist"]) == 84


def test_two_spellings_of_the_base_class_are_one_base(spark, p):
    rows = [series_row("1", qty=[4] * 500), series_row("1", qty=[2] * 300, start=days(300), deliver="自营", ord_="普通"),
            series_row("1", qty=[1] * 500, deliver="FBP")]
    clean = fj.clean_series(make_series(spark, rows), p, checkpoint=False)
    rep = fj.build_report(clean, _forecast(spark, [("1", [1.0] * 35)]), codes.code_dim(spark), p)
    assert sorted((r["deliver_name"], r["ord_name"]) for r in rep.collect()) == [("FBP", "Normal"), ("Self", "Normal")]


def test_repeated_code_alias_gives_one_row(spark, p):
    extra = spark.createDataFrame([("region", "Nowhere", "9"), ("region", "Nowhere", "8")], codes.code_dim(spark).schema)
    df = codes.encode(make_series(spark, [series_row("1", region="Nowhere")]), codes.code_dim(spark, extra), "region", "region_name", "code")
    assert [r["code"] for r in df.collect()] == ["8"]


def test_source_filter_needs_its_partition_column(spark, tmp_path):
    path = str(tmp_path / "flat")
    series_text.series_text(make_series(spark, [series_row("1")])).write.text(path)
    with pytest.raises(ValueError, match="source_type"):
        series_text.read_series(spark, path, "any_source")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_adapter_counts_every_order_line(spark, sf):
    folder = f"/root/testdata/{sf}"
    s = tables.series_from_tables(spark, folder, q.params())
    total = s.select(F.sum(arrays.array_sum(F.col("qty")))).first()[0]
    assert total == spark.read.parquet(f"{folder}/lineitem.parquet").agg(F.sum("l_quantity").cast("bigint")).first()[0]


def test_feature_table_computes_features_once(spark, p):
    """The write has one hash exchange after the features and no sampling job."""
    from stationcast.operators import training

    s = make_series(spark, [series_row(str(i), qty=[1, 2, 3, 9] * 125) for i in range(20)])
    table = training.feature_table(s, make_ref(spark, [("1", "9", [5] * 600, days(600))]), p, measured=False)
    dealt = table.withColumn("_part", F.pmod(F.hash("sta_num"), F.lit(tj.FILES_PER_DAY))).repartition("pre_end", "_part")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(pre_end" in plan and "rangepartitioning" not in plan


def test_no_full_history_in_the_station_window(spark, p):
    rows = allocation.with_station_base(make_series(spark, [series_row("1", qty=[1] * 900, start=days(900))]), p, report.report_span(p))
    r = rows.first()
    assert len(r["qty"]) == 424 and r["start_date"] == days(424) and r["sum60"] == 60
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("slice")     # the cut lies below the window's shuffle
