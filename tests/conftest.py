from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationcast.params import Params  # noqa: E402
from stationcast.sources.series_text import SERIES_COLUMNS  # noqa: E402

T = dt.date(2001, 11, 5)  # a Monday


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("stationcast-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationcast-test-ckpt-"))
    yield s


@pytest.fixture()
def p():
    return Params(as_of=T)


def days(n: int) -> dt.date:
    """The day ``n`` days before the as-of day."""
    return T - dt.timedelta(days=n)


SCHEMA = ("tag string, deliver_type string, ord_type string, region_name string, area_id string, "
          "area_name string, sta_num string, sta_name string, province_id string, city_id string, "
          "county_id string, date_unit string, start_date date, history_len string, unit_len string, "
          "time_span string, qty array<bigint>, remark string")


def series_row(sta="1", start=None, qty=None, deliver="Self", ord_="Normal", city="1", region="North", **kw):
    start = start or days(500)
    qty = qty if qty is not None else [1] * 500
    row = dict(tag="t", deliver_type=deliver, ord_type=ord_, region_name=region, area_id=sta,
               area_name=f"A{sta}", sta_num=sta, sta_name=f"S{sta}", province_id=city, city_id=city,
               county_id=sta, date_unit="day", start_date=start, history_len=str(len(qty)), unit_len="1",
               time_span="", qty=qty, remark="")
    row.update(kw)
    return tuple(row[c] for c in SERIES_COLUMNS)


def make_series(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def make_ref(spark, rows):
    """rows: (city_id, std_sta_num, ref_qty, ref_start)"""
    return spark.createDataFrame(rows, "city_id string, std_sta_num string, ref_qty array<bigint>, ref_start date")
