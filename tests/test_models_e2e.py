"""Train small models on a built training set, score, publish (end to end)."""

from __future__ import annotations

import datetime as dt
import tempfile

from conftest import T, days, make_ref, make_series, series_row
from pyspark.sql import functions as F

import os

from stationcast.functions.dates import model_date_for_forecast, model_date_for_training
from stationcast.operators.models import date_path
from stationcast.operators import training
from stationcast.params import GbtParams
from stationcast.plans import forecast_job as fj, train_job as tj
from stationcast.sources import codes


def test_model_dates():
    # as published: training files under this week's Sunday, forecasting reads last week's Sunday
    for k in range(14):
        d = T + dt.timedelta(days=k)
        assert model_date_for_training(d).weekday() == 6 and 0 <= (model_date_for_training(d) - d).days <= 6
        assert model_date_for_forecast(d) == model_date_for_training(d - dt.timedelta(days=7))


def test_training_grid_shape(spark, p):
    qty = [1 + (i * 7) % 5 for i in range(499)]
    s = make_series(spark, [series_row(sta="1", start=days(500), qty=qty)])
    ref = make_ref(spark, [("1", "1", qty + [1], days(500))])
    rows = training.training_rows(s, ref, p, measured=False)
    got = rows.groupBy("horizon").count().collect()
    assert {r.horizon for r in got} == set(range(35)) and all(r["count"] == 28 for r in got)
    label_days = {r.label_date for r in rows.select("label_date").distinct().collect()}
    assert min(label_days) == days(35) and max(label_days) == days(8)
    chk = rows.select((F.datediff("label_date", "pre_end") - 8 - F.col("horizon")).alias("d")).distinct().collect()
    assert [r.d for r in chk] == [0]


def test_train_then_forecast(spark, p):
    rows = []
    for sta in range(1, 6):
        qty = [sta + (i * 7 + sta) % 5 for i in range(499)]
        rows.append(series_row(sta=str(sta), start=days(500), qty=qty))
        rows.append(series_row(sta=str(sta), deliver="FBP", start=days(500), qty=[q // 2 for q in qty]))
    s = make_series(spark, rows)
    ref = make_ref(spark, [("1", "1", [1 + (i * 7) % 5 for i in range(500)], days(500))])
    small = p.with_(fr_len=3, gbt=GbtParams(max_iter=3, max_depth=3))
    root = tempfile.mkdtemp(prefix="models-")
    train_p = small.with_(as_of=T - dt.timedelta(days=7))
    fitted = tj.run(spark, s, ref, train_p, root)
    assert sorted(fitted["horizons"]) == ["0", "1", "2"] and all(h["trees"] == 3 and h["rows"] for h in fitted["horizons"].values())
    for h in fitted["horizons"].values():
        assert os.path.isdir(f"{date_path(root, model_date_for_training(train_p.as_of))}/{h['path']}")
    out = tempfile.mkdtemp(prefix="report-")
    rep = fj.run(spark, s, ref, codes.code_dim(spark), small, root)
    assert fj.run_and_publish(spark, s, ref, codes.code_dim(spark), small, root, out)[1:] == (10, 0)
    got = {(r.sta_num, r.deliver_name): r for r in rep.collect()}
    assert len(got) == 10
    base = got[("1", "Self")].current_block.forecast
    assert len(base) == 3 and all(x is not None for x in base)
    assert len(got[("1", "FBP")].current_block.forecast) == 3
    assert spark.read.text(f"{out}/{small.as_of.isoformat()}").count() == 10


def test_feature_table_equals_fanout(spark, p):
    """Per horizon, the rows selected from the feature table equal the fan-out training set."""
    qty = [1 + (i * 7) % 5 for i in range(499)]
    rows = [series_row(sta=str(k), start=days(500 - k), qty=[q + k for q in qty[k:]]) for k in range(3)]
    s = make_series(spark, rows)
    ref = make_ref(spark, [("1", "1", qty + [1], days(500))])
    fan = training.training_set(s, ref, p, measured=False)
    table = training.feature_table(s, ref, p, measured=False)
    for h in (0, 17, 34):
        a = sorted((tuple(r.features.toArray()), r.label) for r in fan.where(F.col("horizon") == h).collect())
        b = sorted((tuple(r.features.toArray()), r.label) for r in training.horizon_rows(table, h, p).collect())
        assert a == b and len(a) > 0


def test_training_fresh_dedupe_flag(spark, p):
    """Q8: by default the training job keeps every base series; with the flag, stale ones and shorter
    duplicates are dropped first."""
    qty = [1 + (i * 7) % 5 for i in range(499)]
    rows = [series_row(sta="1", start=days(500), qty=qty),
            series_row(sta="1", start=days(500), qty=qty[:450], remark="dup"),
            series_row(sta="2", start=days(500), qty=qty[:300])]          # stale: ends at T-201
    s = make_series(spark, rows)
    assert training.training_series(s, p).count() == 3
    kept = training.training_series(s, p.with_(train_fresh_dedupe=True)).collect()
    assert [(r.sta_num, len(r.qty)) for r in kept] == [("1", 499)]


def test_trim_to_span_keeps_features(spark, p):
    """Cutting histories before the explode changes no feature, path or label (both city modes)."""
    from stationcast.operators import features as feats

    base = [1 + (i * 7) % 5 for i in range(700)]
    rows = [series_row(sta="1", start=days(700), qty=base[:699]),                 # long: cut
            series_row(sta="2", start=days(425), qty=base[3:427]),                # young: city path
            series_row(sta="3", start=days(200), qty=base[5:204]),                # fallback
            series_row(sta="4", start=days(480), qty=[3] * 479)]                  # constant: fallback
    ref = make_ref(spark, [("1", "9", base[1:701], days(700))])
    for align in (True, False):
        q = p.with_(align_city_by_date=align)
        raw = feats.attach_city_reference(training.training_series(make_series(spark, rows), q)
                                          .select(*training.FEATURE_INPUT), ref, measured=False)
        plain = feats.history_features(training.feature_days(raw, q), q)
        cut = feats.history_features(training.feature_days(training.trim_to_span(raw, q), q), q)
        cols = ["sta_num", "pre_end", "path", "hist",
                training.horizon_labels(q).alias("labels")]
        a = sorted(tuple(r) for r in plain.select(*cols).collect())
        b = sorted(tuple(r) for r in cut.select(*cols).collect())
        assert a == b and len(a) > 60


def test_label_zero_null_or_out_of_range(spark, p):
    """A label of 0, a NULL day or a day past the history keeps the row out of the training set."""
    qty = [1 + (i * 7) % 5 for i in range(499)]
    l_first = training.label_days(p)[0]                      # T-35 is index 465 of a series starting T-500
    with_zero = qty[:465] + [0] + qty[466:]
    with_null = qty[:465] + [None] + qty[466:]
    rows = [series_row(sta="0", start=days(500), qty=with_zero), series_row(sta="N", start=days(500), qty=with_null),
            series_row(sta="S", start=days(500), qty=qty[:465])]  # ends the day before the first label day
    s = make_series(spark, rows)
    df = s.select("sta_num", training.label_at(F.lit(l_first)).alias("label")).collect()
    assert {r.sta_num: r.label for r in df} == {"0": 0, "N": 0, "S": 0}
    ref = make_ref(spark, [("1", "1", qty + [1], days(500))])
    got = training.training_rows(s, ref, p, measured=False).where(F.col("label_date") == F.lit(l_first)).count()
    assert got == 0
