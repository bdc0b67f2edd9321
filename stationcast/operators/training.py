"""Training set (J5, W7, F4, F6, M2): per horizon, features ``8 + h`` days before a label day and that label.

For horizon ``h`` and label day ``L`` the features end at ``pre_end = L - (1 + stable_days + h)``. Over the
``fr_len`` horizons and ``iter_count`` label days only ``fr_len + iter_count - 1`` distinct ``pre_end`` days
occur, so features are computed once per (series, ``pre_end``) and then fanned out to their (horizon, label)
pairs by a generator: no join, no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import py_slice
from ..params import Params
from .features import attach_city_reference, history_features, with_feature_vector
from .series import base_class, dedupe_longest, fresh


def label_days(p: Params) -> tuple[dt.date, dt.date]:
    first = p.first_label_day
    return first, first + dt.timedelta(days=p.iter_count - 1)


def pre_end_days(p: Params) -> tuple[dt.date, dt.date]:
    first_l, last_l = label_days(p)
    return (first_l - dt.timedelta(days=1 + p.stable_days + p.fr_len - 1),
            last_l - dt.timedelta(days=1 + p.stable_days))


def label_at(day: Column) -> Column:
    """Quantity on ``day``; a day outside the history or a NULL day counts as 0."""
    return F.coalesce(F.get(F.col("qty"), F.datediff(day, "start_date")), F.lit(0).cast("bigint"))


def training_series(series: DataFrame, p: Params) -> DataFrame:
    base = base_class(series, p)
    if p.train_fresh_dedupe:
        base = dedupe_longest(fresh(base, p), ["sta_num", "deliver_type", "ord_type"])
    return base


FEATURE_INPUT = ["sta_num", "deliver_type", "ord_type", "start_date", "qty", "province_id", "city_id", "county_id"]


def feature_inputs(series: DataFrame, ref: DataFrame, p: Params, measured: bool = True) -> DataFrame:
    """Training series pruned to the feature inputs, with the city reference attached once per series, and
    histories cut to the span the windows read (before the feature days multiply the rows)."""
    rows = attach_city_reference(training_series(series, p).select(*FEATURE_INPUT), ref, measured)
    return trim_to_span(rows, p)


def trim_to_span(rows: DataFrame, p: Params) -> DataFrame:
    """Drop history days before ``keep_from``, the day before the earliest window day of any feature day, and
    move ``start_date`` (and ``ref_start``) to the first kept day.

    Every day a window or label reads is on or after ``keep_from + 1``, so offsets, the strict "starts before the
    earliest window" test (F4) and the young-station test (``keep_from`` is before its threshold) give the same
    answers; only the copies made by the feature-day explode shrink. The city series is positioned by date
    only when ``align_city_by_date`` is set, so only then is it cut too.
    """
    lo, _ = pre_end_days(p)
    keep_from = F.lit(lo - dt.timedelta(days=p.cycle_len + p.window_len + 1))
    cut = F.greatest(F.datediff(keep_from, "start_date"), F.lit(0))
    rows = rows.withColumn("qty", py_slice(F.col("qty"), cut, None)).withColumn("start_date", F.date_add("start_date", cut))
    if p.align_city_by_date:
        rcut = F.greatest(F.datediff(keep_from, "ref_start"), F.lit(0))
        rows = (rows.withColumn("ref_qty", py_slice(F.col("ref_qty"), rcut, None))
                .withColumn("ref_start", F.date_add("ref_start", rcut)))
    return rows


def feature_days(series: DataFrame, p: Params) -> DataFrame:
    """One row per (series, ``pre_end``) whose nine offsets are all positive (F4): the series starts before
    the earliest window."""
    lo, hi = pre_end_days(p)
    rows = series.withColumn("pre_end", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY"))))
    earliest = F.date_sub("pre_end", p.cycle_len + p.window_len)
    return rows.where(F.col("start_date") < earliest)


def training_rows(series: DataFrame, ref: DataFrame, p: Params, measured: bool = True) -> DataFrame:
    """``(horizon, label_date, pre_end, sta_num, path, hist, label, …)`` rows with a positive label."""
    feats = history_features(feature_days(feature_inputs(series, ref, p, measured), p), p)
    first_l, last_l = label_days(p)
    gap = 1 + p.stable_days
    h_lo = F.greatest(F.lit(0), F.datediff(F.lit(first_l), "pre_end") - gap)
    h_hi = F.least(F.lit(p.fr_len - 1), F.datediff(F.lit(last_l), "pre_end") - gap)
    out = (feats.withColumn("horizon", F.explode(F.sequence(h_lo, h_hi)))
           .withColumn("label_date", F.date_add("pre_end", (F.col("horizon") + gap).cast("int")))
           .withColumn("label", label_at(F.col("label_date")))
           .where(F.col("label") > 0))
    return out


def training_set(series: DataFrame, ref: DataFrame, p: Params, measured: bool = True) -> DataFrame:
    """``(horizon, label_date, sta_num, features, label)`` ready for one regressor per horizon."""
    rows = with_feature_vector(training_rows(series, ref, p, measured))
    return rows.select("horizon", "label_date", "sta_num", "path", "features",
                       F.col("label").cast("double").alias("label"))


def horizon_labels(p: Params) -> Column:
    """The ``fr_len`` labels of a feature row: ``qty`` at ``pre_end + 1 + stable_days + h``, ``h = 0 ..``."""
    gap = 1 + p.stable_days
    return F.transform(F.sequence(F.lit(0), F.lit(p.fr_len - 1)),
                       lambda h: label_at(F.date_add("pre_end", (h + gap).cast("int"))))


def feature_table(series: DataFrame, ref: DataFrame, p: Params, measured: bool = True) -> DataFrame:
    """``(pre_end, sta_num, path, features, labels)``: one row per (series, feature day), with the label of
    every horizon as an array. The training set of horizon ``h`` is a filter and a projection of this table
    (``horizon_rows``), so the ``fr_len x iter_count`` fan-out is never written."""
    feats = with_feature_vector(history_features(feature_days(feature_inputs(series, ref, p, measured), p), p))
    return feats.select("pre_end", "sta_num", "path", "features", horizon_labels(p).alias("labels"))


def horizon_days(horizon: int, p: Params) -> Column:
    """The ``iter_count`` feature days whose label day is a label day: a range on ``pre_end``."""
    first_l, last_l = label_days(p)
    gap = dt.timedelta(days=1 + p.stable_days + horizon)
    return F.col("pre_end").between(F.lit(first_l - gap), F.lit(last_l - gap))


def horizon_filter(horizon: int, p: Params) -> Column:
    """Rows of ``feature_table`` that train a horizon: its feature days, positive labels only."""
    return horizon_days(horizon, p) & (F.col("labels")[horizon] > 0)


def horizon_rows(table: DataFrame, horizon: int, p: Params) -> DataFrame:
    """``(sta_num, pre_end, features, label)`` of one horizon from ``feature_table`` (pruned to its partitions when the
    table is partitioned by ``pre_end``)."""
    return (table.where(horizon_days(horizon, p)).where(F.col("labels")[horizon] > 0)
            .select("sta_num", "pre_end", "features", F.col("labels")[horizon].cast("double").alias("label")))
