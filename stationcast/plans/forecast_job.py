"""Forecast job: series -> fresh, deduplicated -> base-class features -> 35-day forecast per station ->
allocation to the other classes -> report.

Shuffles: one for the dedupe (partial ``max_by``), one for the per-station window (base 60-day sum), and the
join of the per-station forecast, which is broadcast when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import allocation, evaluation, features, models, report, series as ser
from ..operators.joins import sized_broadcast
from ..params import Params
from ..session import scratch, shared_dir, stored
from ..sources.series_text import SERIES_COLUMNS

KEY = ["sta_num", "deliver_type", "ord_type"]
UNREAD = ("tag", "date_unit", "history_len", "unit_len", "time_span", "remark")


def clean_series(series: DataFrame, p: Params, checkpoint: bool = True) -> DataFrame:
    """Fresh series as known on the as-of day, one per (station, delivery type, order type) and so one base series per
    station; columns that nothing reads do not cross the dedupe's shuffle. Checkpointed because the base-class
    branch (features, scoring) and the report branch both read it."""
    needed = [c for c in series.columns if c in SERIES_COLUMNS and c not in UNREAD]
    known = ser.known_at(ser.normalised(series.select(*needed)), p)
    clean = ser.dedupe_longest(ser.fresh(known, p), KEY)
    if checkpoint:
        shared_dir(series.sparkSession)
        clean = clean.checkpoint(eager=True)
    return clean


def model_forecasts(clean: DataFrame, ref: DataFrame, p: Params, model_root: str) -> DataFrame:
    """``(sta_num, forecast)`` for base-class series with a full feature row, by the models in last week's folder of
    ``model_root``."""
    feats = features.with_feature_vector(features.forecast_features(ser.base_class(clean, p), ref, p))
    return models.score(feats, model_root, models.forecast_model_date(p), p)


def naive_forecasts(clean: DataFrame, p: Params) -> DataFrame:
    """``(sta_num, forecast)`` from the seasonal-naive baseline (checks and back-tests)."""
    return ser.base_class(clean, p).select("sta_num", evaluation.naive_forecast(p).alias("forecast"))


def allocated(clean: DataFrame, station_fc: DataFrame, p: Params, measure: bool = True) -> DataFrame:
    """Every clean row with its ``forecast``: the base forecast for the base class, the allocated and capped
    one for the other classes (NULL when the station has no base row)."""
    rows = allocation.with_station_base(clean, p, report.report_span(p))
    fc = station_fc.select("sta_num", F.col("forecast").alias("base_forecast"))
    fc = sized_broadcast(fc, ("base_forecast",)) if measure else fc
    rows = rows.join(fc, "sta_num", "left")
    alloc = allocation.allocation(F.col("base_forecast"), allocation.allocation_factor(p), F.col("qty"), p)
    rows = rows.withColumn("allocation", F.when(~F.col("is_base") & F.col("has_base"), alloc))
    return rows.withColumn(
        "forecast", F.when(F.col("is_base"), F.col("base_forecast")).otherwise(F.col("allocation")["forecast"]))


def build_report(clean: DataFrame, station_fc: DataFrame, codes: DataFrame, p: Params) -> DataFrame:
    return report.report_rows(allocated(clean, station_fc, p), codes, p)


def run(spark: SparkSession, series: DataFrame, ref: DataFrame, codes: DataFrame, p: Params, model_root: str) -> DataFrame:
    """The typed report of the whole forecast, for a caller that reads it in this session; its checkpoints belong to the session."""
    clean = clean_series(series, p)
    station_fc = model_forecasts(clean, ref, p, model_root).checkpoint(eager=True)
    return build_report(clean, station_fc, codes, p)


def run_and_publish(spark: SparkSession, series: DataFrame, ref: DataFrame, codes: DataFrame, p: Params, model_root: str, out_root: str,
                    files: int = 5) -> report.Published:
    """The whole forecast job: builds the report once, publishes its text and counts its lines and unknown names on the way. Intermediate
    tables are deleted at the end, however the job ends."""
    with scratch(spark) as folder:
        clean = stored(clean_series(series, p, checkpoint=False), folder("clean_series"))
        cities = stored(ref, folder("city_reference"))
        station_fc = stored(model_forecasts(clean, cities, p, model_root), folder("station_forecast"))
        return report.publish(build_report(clean, station_fc, codes, p), out_root, p, files=files)
