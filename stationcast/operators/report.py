"""Report rows (W9-W13, R4-R7) and the text export.

Per series: the last 60 days, 28 forecast days, the forecast to the end of the week, nine rolling 7-day sums,
and the same four parts one year earlier when the history is longer than a year.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.arrays import py_slice, rolling_week_sums
from ..functions.dates import next_monday
from ..params import Params
from ..session import exists, move, release
from ..sources import codes as code_dim
from ..sources.series_text import NULL_MARK

REPORT_COLUMNS = ["region_id", "region_name", "area_id", "area_name", "sta_num", "sta_name", "data_date",
                  "next_monday", "fr_type", "ord_type", "delivered_flag", "current_block", "year_ago_block"]

# Offsets (days from the end of the padded history) of the year-ago report parts.
YEAR_AGO_RECENT = (-424, -364)
YEAR_AGO_FORECAST = (-364, -336)
YEAR_AGO_ROLLING_END = -276
ROLLING_SKIP = 10


def real_len(p: Params) -> Column:
    """Days from the series start to yesterday, both included."""
    return F.datediff(F.lit(p.yesterday), "start_date") + 1


def report_span(p: Params) -> int:
    """Days from the end of the padded history that any report part reads."""
    return max(-YEAR_AGO_RECENT[0], p.recent_days, ROLLING_SKIP + 9 + 7, -YEAR_AGO_ROLLING_END + 9 + 7)


def padded_tail(p: Params) -> Column:
    """The last ``report_span`` days of the history zero-padded to ``real_len`` days, built without padding
    the whole history: ``z`` appended zeros (at most the span) after the last ``span - z`` recorded days.
    Every report part slices by offsets from the end, so the tail gives the same slices."""
    span = report_span(p)
    qty = F.col("qty")
    zeros = F.least(F.greatest(real_len(p) - F.size(qty), F.lit(0)), F.lit(span))
    head = py_slice(qty, F.greatest(F.size(qty) - (F.lit(span) - zeros), F.lit(0)), None)
    return F.concat(head, F.array_repeat(F.lit(0).cast("bigint"), zeros.cast("int")))


def blocks(padded: Column, forecast: Column, p: Params) -> tuple[Column, Column]:
    """``(current_block, year_ago_block)`` structs of four arrays each; the second is NULL for a series with
    at most a year of history."""
    w = p.rest_of_week
    fc = F.coalesce(forecast, F.array().cast("array<double>"))
    cur = F.struct(
        py_slice(padded, -p.recent_days, None).alias("recent"),
        py_slice(fc, 0, p.fc_report_days).alias("forecast"),
        py_slice(fc, p.fc_report_days, p.fc_report_days + w).alias("week_rest"),
        rolling_week_sums(padded, -ROLLING_SKIP).alias("rolling"),
    )
    ago = F.struct(
        py_slice(padded, *YEAR_AGO_RECENT).alias("recent"),
        py_slice(padded, YEAR_AGO_FORECAST[0], YEAR_AGO_FORECAST[1]).alias("forecast"),
        py_slice(padded, YEAR_AGO_FORECAST[1], YEAR_AGO_FORECAST[1] + w).alias("week_rest"),
        rolling_week_sums(padded, YEAR_AGO_ROLLING_END + w).alias("rolling"),
    )
    return cur, F.when(real_len(p) > p.cycle_len, ago)


def report_rows(rows: DataFrame, codes: DataFrame, p: Params) -> DataFrame:
    """Typed report (R6) from series rows that carry a ``forecast`` column (NULL = no forecast)."""
    df = code_dim.encode(rows, None, "deliver", "deliver_type", "fr_type")
    df = code_dim.encode(df, None, "ord", "ord_type", "ord_code")
    df = code_dim.encode(df, codes, "region", "region_name", "region_id")
    # the padded tail feeds eight slices: computed once as a column (not inlined into each slice)
    df = df.withColumn("_padded", padded_tail(p))
    cur, ago = blocks(F.col("_padded"), F.col("forecast"), p)
    return df.select(
        "region_id", "region_name", "area_id", "area_name", "sta_num", "sta_name",
        F.lit(p.yesterday).alias("data_date"), F.lit(next_monday(p.yesterday)).alias("next_monday"),
        "fr_type", F.col("ord_code").alias("ord_type"), F.lit("1").alias("delivered_flag"),
        cur.alias("current_block"), ago.alias("year_ago_block"),
        F.col("deliver_type").alias("deliver_name"), F.col("ord_type").alias("ord_name"))


def quarantined_rows(report: DataFrame) -> DataFrame:
    """Report rows whose delivery, order or region name has no code (published with an empty code field)."""
    return report.where(code_dim.quarantined(report, ["fr_type", "ord_type", "region_id"]))


def number_text(x: Column) -> Column:
    """A number rounded to six places, without exponent: ``12.0``, ``3.333333``."""
    return F.regexp_replace(x.cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1")


def _block_text(b: Column, kinds: dict[str, str]) -> Column:
    """The four parts of a block; a NULL element is written as the null mark, so every value keeps its day."""
    def text(name):
        whole = kinds[name] == "bigint"
        return F.array_join(F.transform(b[name], lambda x: F.coalesce(
            x.cast("string") if whole else number_text(x), F.lit(NULL_MARK))), ",")

    parts = [text(name) for name in ("recent", "forecast", "week_rest", "rolling")]
    return F.when(b.isNull(), F.lit("$$$")).otherwise(F.concat_ws("$", *parts))


def report_text(report: DataFrame) -> DataFrame:
    """One ``#``-joined line per report row: an empty first and last field around the 13 columns."""
    fields = [F.lit("")]
    for c in REPORT_COLUMNS:
        if c in ("current_block", "year_ago_block"):
            fields.append(_block_text(F.col(c), {f.name: f.dataType.elementType.simpleString()
                                                 for f in report.schema[c].dataType.fields}))
        elif c in ("data_date", "next_monday"):
            fields.append(F.date_format(c, "yyyy-MM-dd"))
        else:
            fields.append(F.coalesce(F.col(c).cast("string"), F.lit("")))
    fields.append(F.lit(""))
    return report.select(F.concat_ws("#", *fields).alias("value"))


class Published(NamedTuple):
    """Where a report stands, its lines, and how many of them have a name without a code."""

    path: str
    lines: int
    unknown: int


def publish(report: DataFrame, root: str, p: Params, files: int = 5, codec: str = "deflate") -> Published:
    """Write the report text under ``<root>/<as_of>`` (replacing a previous run), ``files`` files.

    The lines are written beside their place and renamed into it, so a report that fails half-way leaves the one before it;
    they are counted on the way, in the same execution. ``repartition`` rather than ``coalesce``: the upstream stages
    keep their parallelism and only the finished text lines are shuffled into ``files`` tasks.
    """
    spark, root = report.sparkSession, root.rstrip("/")
    path, staged, old = f"{root}/{p.as_of.isoformat()}", f"{root}/.staged-{uuid.uuid4().hex}", f"{root}/.old-{uuid.uuid4().hex}"
    seen = Observation()
    unknown = code_dim.quarantined(report, ["fr_type", "ord_type", "region_id"])
    counted = report.observe(seen, F.count(F.lit(1)).alias("lines"), F.count(F.when(unknown, F.lit(1))).alias("unknown"))
    try:
        report_text(counted).repartition(files).write.option("compression", codec).text(staged)
        if replaces := exists(spark, path):
            move(spark, path, old)
        try:
            move(spark, staged, path)
        except Exception:
            if replaces:
                move(spark, old, path)
            raise
        release(spark, old)
    finally:
        release(spark, staged)
    return Published(path, seen.get["lines"], seen.get["unknown"])
