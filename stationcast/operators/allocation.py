"""Allocation of the base-class forecast to the other classes of a station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import array_dsum, array_sum, let, py_slice
from ..params import Params
from .series import is_base


def sum_recent(p: Params) -> Column:
    """Sum of the last ``recent_days`` days after zero-padding the history to ``datediff(T-1, start)`` days.

    The pad target is one day shorter than the report's (SURVEY Q5), kept as published. Only the tail that is summed is
    cut out; zeros add nothing. A NULL day counts as 0 (Q11).
    """
    n = F.size("qty")
    zeros = F.least(F.greatest(F.datediff(F.lit(p.yesterday), "start_date") - n, F.lit(0)), F.lit(p.recent_days))
    return array_sum(py_slice(F.col("qty"), F.greatest(n - (F.lit(p.recent_days) - zeros), F.lit(0)), None))


def ratio_expr(sum_col: Column, base_col: Column) -> Column:
    """``other / base``; 1 when the base class sold nothing (as published)."""
    return F.when(base_col == 0, F.lit(1.0)).otherwise(sum_col.cast("double") / base_col.cast("double"))


def class_ratio(series: DataFrame, p: Params) -> DataFrame:
    """``(sta_num, deliver_type, ord_type, sum60, base60, ratio)`` for every non-base class.

    ``series`` is fresh and deduplicated. Classes of a station without a base-class row get no ratio (F11).
    The base sum reaches the other classes through a window over ``sta_num`` on a narrow projection (no
    arrays): one exchange, and each window group holds one row per class.
    """
    from pyspark.sql.window import Window

    narrow = series.select("sta_num", "deliver_type", "ord_type", sum_recent(p).alias("sum60"),
                           is_base(p).alias("is_base"))
    w = Window.partitionBy("sta_num")
    return (narrow.withColumn("base60", F.max(F.when(F.col("is_base"), F.col("sum60"))).over(w))
            .where(~F.col("is_base") & F.col("base60").isNotNull())
            .select("sta_num", "deliver_type", "ord_type", "sum60", "base60",
                    ratio_expr(F.col("sum60"), F.col("base60")).alias("ratio")))


def keep_tail(df: DataFrame, days: int) -> DataFrame:
    """Histories cut to their last ``days`` days, with ``start_date`` moved to the first kept day, so offsets from the end
    and the days missing after it stay the same."""
    cut = F.greatest(F.size("qty") - F.lit(days), F.lit(0))
    return (df.withColumn("_cut", cut).withColumn("qty", py_slice(F.col("qty"), F.col("_cut"), None))
            .withColumn("start_date", F.date_add("start_date", F.col("_cut"))).drop("_cut"))


def with_station_base(series: DataFrame, p: Params, tail_days: int) -> DataFrame:
    """Every row plus its station's base-class 60-day sum (``base60``) and whether a base row exists; histories are cut to
    the ``tail_days`` that later steps read, before they cross the shuffle.

    One window over ``sta_num``: after the dedupe a station holds one row per class, so each window group is
    bounded by the number of classes.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy("sta_num")
    return (keep_tail(series.withColumn("sum60", sum_recent(p)), tail_days)
            .withColumn("is_base", is_base(p))
            .withColumn("base60", F.max(F.when(F.col("is_base"), F.col("sum60"))).over(w))
            .withColumn("has_base", F.max(F.col("is_base").cast("int")).over(w) == 1))


def allocation_factor(p: Params) -> Column:
    """Multiplier of the base forecast for a row with ``sum60``/``base60``/``has_base`` columns.

    As published a ratio of exactly 1 means "no base volume" and allocates 0; with ``ratio_one_is_zero`` off
    (default) only a zero base allocates 0 and a genuine 1.0 stays 1.0 (SURVEY Q4).
    """
    r = ratio_expr(F.col("sum60"), F.col("base60"))
    if p.ratio_one_is_zero:
        return F.when(r == 1.0, F.lit(0.0)).otherwise(r)
    return F.when(F.col("base60") == 0, F.lit(0.0)).otherwise(r)


def allocation(forecast: Column, factor: Column, qty: Column, p: Params) -> Column:
    """Struct of the allocated ``forecast``, the scaled total before the cap (``scaled_total``), the trailing sum
    (``recent35``) and whether the cap applied (``capped``).

    The scaled base forecast is flattened to ``sum(last 35 days) / 35`` when it exceeds ``cap_factor`` times that sum. A
    NULL forecast (no base forecast at the station) gives an empty forecast, as published.
    """
    fc = F.coalesce(forecast, F.array().cast("array<double>"))
    scaled = F.transform(fc, lambda x: x * factor)
    recent = py_slice(qty, -p.cap_days, None)
    recent_sum = F.aggregate(recent, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0)).cast("double"))
    def build(s):
        flat = F.array_repeat(s["recent35"] / float(p.cap_days), p.fr_len)
        return F.struct(F.when(s["total"] > p.cap_factor * s["recent35"], flat).otherwise(s["scaled"]).alias("forecast"),
                        s["total"].alias("scaled_total"), s["recent35"].alias("recent35"),
                        (s["total"] > p.cap_factor * s["recent35"]).alias("capped"))
    return let(scaled, lambda a: let(F.struct(a.alias("scaled"), array_dsum(a).alias("total"), recent_sum.alias("recent35")), build))


def allocate(forecast: Column, factor: Column, qty: Column, p: Params) -> Column:
    """The allocated forecast alone (see ``allocation``)."""
    return allocation(forecast, factor, qty, p)["forecast"]
