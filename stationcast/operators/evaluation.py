"""Back-testing (W8): the 35 actual days from the as-of day, and the error of a forecast against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import py_slice
from ..params import Params


def actuals(series: DataFrame, p: Params) -> DataFrame:
    """``(sta_num, deliver_type, ord_type, actual)`` for series that cover ``[T, T + fr_len)`` completely."""
    lo = F.datediff(F.lit(p.as_of), "start_date")
    a = F.when(lo >= 0, py_slice(F.col("qty"), lo, lo + p.fr_len))
    return (series.select("sta_num", "deliver_type", "ord_type", a.alias("actual"))
            .where(F.size("actual") == p.fr_len))


def naive_forecast(p: Params) -> Column:
    """Baseline: the quantity ``fr_len`` days before each forecast day (0 outside the history)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(p.fr_len - 1)),
        lambda h: F.coalesce(
            F.get(F.col("qty"), F.datediff(F.lit(p.as_of), "start_date") - p.fr_len + h),
            F.lit(0).cast("bigint")).cast("double"))


def rmse(forecast: DataFrame, actual: DataFrame, fc_col: str = "forecast") -> DataFrame:
    """Root mean squared error per horizon over the stations present in both frames, on all known days (``rmse``, ``n``) and
    on the days with a sale, which are the only ones that train a model (``rmse_sold``, ``n_sold``)."""
    j = forecast.join(actual, ["sta_num"])
    error = F.pow(F.col("pair.f") - F.col("pair.a"), 2)
    sold = F.col("pair.a") > 0
    return (j.select(F.posexplode(F.arrays_zip(F.col(fc_col).alias("f"), F.col("actual").alias("a")))
                     .alias("horizon", "pair"))
            .groupBy("horizon")
            .agg(F.sqrt(F.avg(error)).alias("rmse"), F.count(F.lit(1)).alias("n"),
                 F.sqrt(F.avg(F.when(sold, error))).alias("rmse_sold"), F.count(F.when(sold, F.lit(1))).alias("n_sold")))


def pre_mean_forecast(features: DataFrame, p: Params) -> DataFrame:
    """Baseline from feature rows: the mean of the cleaned recent window (the first ``window_len`` history
    values), repeated for every horizon. ``(sta_num, forecast)``."""
    recent = F.slice("hist", 1, p.window_len)
    mean = F.aggregate(recent, F.lit(0.0), lambda a, x: a + x) / F.size(recent)
    return features.select("sta_num", F.array_repeat(mean, p.fr_len).alias("forecast"))
