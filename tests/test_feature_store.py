"""Features kept between trainings equal those computed from scratch, and only what is missing is computed."""

from __future__ import annotations

import datetime as dt
import glob
import os
import tempfile
from collections import Counter

import pytest
from conftest import T, days, make_ref, make_series, series_row
from pyspark.sql import functions as F

from stationcast.operators import feature_store as store
from stationcast.operators import training
from stationcast.params import GbtParams, Params
from stationcast.plans import train_job as tj
from stationcast.session import scratch

THIS = Params(as_of=T)
LAST = THIS.with_(as_of=T - dt.timedelta(days=7))
BASE = [1 + (i * 7) % 5 for i in range(700)]


def rows_of(qty3=None):
    return [series_row(sta="1", start=days(700), qty=BASE[:699]),
            series_row(sta="2", start=days(431), qty=BASE[3:433]),                # young for THIS, not for LAST's earlier threshold
            series_row(sta="3", start=days(480), qty=qty3 or BASE[5:484]),
            series_row(sta="4", start=days(480), qty=[3] * 479),                  # constant: fallback
            series_row(sta="5", start=days(500), qty=[None] * 499),               # no valid history
            series_row(sta="6", start=days(500), qty=BASE[1:500]), series_row(sta="6", start=days(500), qty=BASE[1:500])]


def ref_of(spark, shift=0):
    return make_ref(spark, [("1", "9", [x + shift for x in BASE[1:701]], days(700))])


def plain(series, ref, p):
    return Counter(map(str, training.feature_table(series, ref, p, measured=False).collect()))


def through(spark, series, ref, p, path):
    inputs = training.feature_inputs(series, ref, p, measured=False)
    with scratch(spark) as folder:
        return Counter(map(str, store.feature_rows(inputs, p, path, folder, 2).collect()))


def held(spark, path):
    """Stored rows by station and day; a key is never there twice."""
    got = spark.read.schema(store.SCHEMA).parquet(path)
    assert got.count() == got.select(*store.KEYS).distinct().count()
    return Counter((r.sta_num, r.pre_end) for r in got.select("sta_num", "pre_end").collect())


@pytest.fixture()
def filled(spark):
    path = f"{tempfile.mkdtemp(prefix='features-')}/store"
    series, ref = make_series(spark, rows_of()), ref_of(spark)
    assert through(spark, series, ref, LAST, path) == plain(series, ref, LAST)
    return path


def test_next_week_computes_seven_days_and_what_changed_age(spark, filled):
    series, ref = make_series(spark, rows_of()), ref_of(spark)
    before = held(spark, filled)
    want = plain(series, ref, THIS)
    assert through(spark, series, ref, THIS, filled) == want and max(want.values()) == 2      # a repeated series counts twice
    added = held(spark, filled) - before
    new_days = {LAST_HI + dt.timedelta(days=k) for k in range(1, 8)}
    assert {d for s, d in added if s != "2"} == new_days
    assert {d for s, d in added if s == "2"} >= new_days
    assert through(spark, series, ref, THIS, filled) == want and held(spark, filled) == before + added   # nothing is left to compute


LAST_HI = training.pre_end_days(LAST)[1]


def test_station_that_stops_being_young_is_computed_again(spark):
    start = LAST.new_station_threshold + dt.timedelta(days=3)
    assert LAST.new_station_threshold < start <= THIS.new_station_threshold
    n = (T - start).days
    series, ref = make_series(spark, [series_row(sta="2", start=start, qty=BASE[:n - 1])]), ref_of(spark)
    path = f"{tempfile.mkdtemp(prefix='features-')}/store"
    through(spark, series, ref, LAST, path)
    want = plain(series, ref, THIS)
    assert through(spark, series, ref, THIS, path) == want and "own" in str(want)
    assert 2 in held(spark, path).values()


def test_restated_day_recomputes_only_the_windows_that_read_it(spark, filled):
    qty = BASE[5:484]
    qty[479 - 30] += 100
    series, ref = make_series(spark, rows_of(qty)), ref_of(spark)
    before = held(spark, filled)
    assert through(spark, series, ref, LAST, filled) == plain(series, ref, LAST)
    added = held(spark, filled) - before
    assert added and {s for s, _ in added} == {"3"}
    day = days(480) + dt.timedelta(days=479 - 30)
    assert {d for _, d in added} == {day + dt.timedelta(days=k) for k in range(1, 31)} & {d for s, d in before if s == "3"}


def test_other_city_reference(spark, filled):
    series, ref = make_series(spark, rows_of()), ref_of(spark, 4)
    assert through(spark, series, ref, LAST, filled) == plain(series, ref, LAST)


def test_lost_files_are_made_good(spark, filled):
    series, ref = make_series(spark, rows_of()), ref_of(spark)
    before = held(spark, filled)
    for f in glob.glob(f"{filled}/pre_end={LAST_HI.isoformat()}/*.parquet")[:1]:
        os.remove(f)
    assert held(spark, filled) != before
    assert through(spark, series, ref, LAST, filled) == plain(series, ref, LAST) and held(spark, filled) == before


def test_feature_inputs_are_dealt_evenly(spark, monkeypatch):
    """A few small files of series are work for every task: neither the scan's splits nor merging by size decides."""
    path = f"{tempfile.mkdtemp(prefix='series-')}"
    make_series(spark, [series_row(sta=str(k), start=days(480), qty=BASE[:479]) for k in range(64)]).coalesce(1).write.parquet(f"{path}/s")
    inputs, seen = training.feature_inputs(spark.read.parquet(f"{path}/s"), ref_of(spark), THIS, measured=False), []

    def update(inputs, *rest):
        seen.append(Counter(r[0] for r in inputs.select(F.input_file_name()).collect()))

    monkeypatch.setattr(store, "update", update)
    with scratch(spark) as folder:
        store.feature_rows(inputs, THIS, f"{path}/store", folder, 2)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(seen[0]) == n and max(seen[0].values()) <= 64 / n + n


def test_no_series(spark):
    path = f"{tempfile.mkdtemp(prefix='features-')}/store"
    assert not through(spark, make_series(spark, []), ref_of(spark), THIS, path)


def test_training_with_a_store(spark):
    """Two trainings a week apart: the second commits the same trees as one without a store; days before its first are gone."""
    rows = [series_row(sta=str(k), start=days(510), qty=[k + (i * 7 + k) % 5 for i in range(509)]) for k in range(1, 5)]
    series, ref = make_series(spark, rows), ref_of(spark)
    root, path = tempfile.mkdtemp(prefix="models-"), f"{tempfile.mkdtemp(prefix='features-')}/store"
    small = dict(fr_len=2, gbt=GbtParams(max_iter=2, max_depth=2))
    tj.run(spark, series, ref, LAST.with_(**small), root, "before", path)
    one = tj.run(spark, series, ref, THIS.with_(**small), root, "stored", path)
    two = tj.run(spark, series, ref, THIS.with_(**small), root, "plain")
    trees = [sorted(map(tuple, spark.read.parquet(*glob.glob(f"{root}/*/attempt={m['attempt']}/nodes")).collect())) for m in (one, two)]
    assert trees[0] == trees[1] and trees[0]
    assert min(store.days_in(spark, path)) == training.pre_end_days(THIS.with_(**small))[0]
    assert spark.read.schema(store.SCHEMA).parquet(path).where(F.col("values").isNull()).count() == 0
