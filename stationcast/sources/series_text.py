"""The packed-series text format (S1, P1-P3), the city reference (S2, J3) and their writers.

Series line: 9 fields separated by ``\\x01``; field 1 is a row key of 10 ``$``-separated sub-fields; the daily
history is one ``", "``-separated text field. Files live under ``<root>/source_type=<s>/date_type=<d>/``, so the
two path levels are partition columns and a filter on them prunes directories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field layout of a series line.
ROWKEY_COLUMNS = ["deliver_type", "ord_type", "region_name", "area_id", "area_name", "sta_num", "sta_name",
                  "province_id", "city_id", "county_id"]
TAIL_COLUMNS = ["date_unit", "start_date", "history_len", "unit_len", "time_span", "his_ts_qttys", "remark"]
NULL_MARK = "\\N"

SERIES_COLUMNS = ["tag"] + ROWKEY_COLUMNS + ["date_unit", "start_date", "history_len", "unit_len", "time_span",
                                             "qty", "remark"]


def parse_qty(text: Column) -> Column:
    """``"1, 0, 4"`` to ``ARRAY<BIGINT>``; the null marker or a blank element becomes a NULL element."""
    return F.transform(F.split(text, ", ", -1),
                       lambda x: F.when(x == F.lit(NULL_MARK), None).otherwise(x.try_cast("bigint")))


def _fields() -> tuple[Column, Column, Column]:
    """The fields of a line, the sub-fields of its row key and its start date (NULL if there is none)."""
    f = F.split(F.col("value"), "\u0001", -1)
    return f, F.split(F.get(f, F.lit(1)), "\\$", -1), F.to_date(F.try_to_timestamp(F.get(f, F.lit(3)), F.lit("yyyy-MM-dd")))


def fault(kind: str = "series") -> Column:
    """Why a line cannot be read, NULL for a good one: ``blank``, ``fields`` or ``row key`` (their number), ``start date``."""
    if kind == "series":
        f, key, start = _fields()
        n, bad_key = 2 + len(TAIL_COLUMNS), F.size(key) != len(ROWKEY_COLUMNS)
    else:
        f = F.split(F.col("value"), "#", -1)
        n, bad_key, start = 4, F.lit(False), F.to_date(F.try_to_timestamp(F.get(f, F.lit(3)), F.lit("yyyy-MM-dd")))
    return (F.when(F.trim("value") == "", F.lit("blank")).when(F.size(f) != n, F.lit("fields")).when(bad_key, F.lit("row key"))
            .when(start.isNull(), F.lit("start date")))


def parse_series(lines: DataFrame) -> DataFrame:
    """Typed series rows from raw text lines (column ``value``); extra columns (partitions) are kept. Lines with a ``fault`` are left
    out: ``write_rejects`` reports them."""
    f, key, start = _fields()
    cols = [F.get(f, F.lit(0)).alias("tag")]
    cols += [F.get(key, F.lit(i)).alias(name) for i, name in enumerate(ROWKEY_COLUMNS)]
    for i, name in enumerate(TAIL_COLUMNS, 2):
        field = F.get(f, F.lit(i))
        cols.append({"start_date": start.alias(name), "his_ts_qttys": parse_qty(field).alias("qty")}.get(name, field.alias(name)))
    extra = [c for c in lines.columns if c != "value"]
    return lines.where(fault().isNull()).select(*cols, *extra)


class TooManyRejects(RuntimeError):
    """More lines of an input cannot be read than the job allows."""


def write_rejects(lines: DataFrame, path: str, limit: int, kind: str = "series") -> dict[str, int]:
    """Writes the lines that cannot be read as a table ``(value, reason, …)`` and returns how many there are by reason (a handful of
    reasons); with more than ``limit`` of them the job stops, the table being there to look at. Reads the text once and parses no history."""
    bad = lines.withColumn("reason", fault(kind)).where(F.col("reason").isNotNull())
    bad.write.mode("overwrite").parquet(path)
    counts = {r["reason"]: r["count"] for r in lines.sparkSession.read.schema(bad.schema).parquet(path).groupBy("reason").count().collect()}
    if sum(counts.values()) > limit:
        raise TooManyRejects(f"{sum(counts.values())} lines cannot be read ({counts}), {limit} are allowed; see {path}")
    return counts


def read_series(spark: SparkSession, root: str, source_type: str | None = None, date_type: str | None = "day") -> DataFrame:
    """Scan the series table; ``source_type`` / ``date_type`` select partitions (directory pruning)."""
    return parse_series(series_lines(spark, root, source_type, date_type))


def series_lines(spark: SparkSession, root: str, source_type: str | None = None, date_type: str | None = "day") -> DataFrame:
    """The raw lines of the selected partitions."""
    lines = spark.read.option("basePath", root).text(root)
    for name, wanted in (("source_type", source_type), ("date_type", date_type)):
        if wanted is not None:
            if name not in lines.columns:
                raise ValueError(f"{root} has no partition column {name}, so {name}={wanted!r} cannot be selected")
            lines = lines.where(F.col(name) == wanted)
    return lines


def series_text(df: DataFrame) -> DataFrame:
    """The inverse of ``parse_series``: one ``value`` text column per row (partition columns kept)."""
    qty_text = F.array_join(F.transform("qty", lambda x: F.coalesce(x.cast("string"), F.lit(NULL_MARK))), ", ")
    key = F.concat_ws("$", *[F.coalesce(F.col(c), F.lit("")) for c in ROWKEY_COLUMNS])
    fields = [F.col("tag"), key, F.col("date_unit"), F.date_format("start_date", "yyyy-MM-dd"), F.col("history_len"),
              F.col("unit_len"), F.col("time_span"), qty_text, F.col("remark")]
    fields = [F.coalesce(c, F.lit("")) for c in fields]
    extra = [c for c in ("source_type", "date_type") if c in df.columns]
    return df.select(F.concat_ws("\u0001", *fields).alias("value"), *extra)


def write_series(df: DataFrame, root: str, source_type: str, date_type: str = "day", mode: str = "overwrite") -> None:
    out = df.withColumn("source_type", F.lit(source_type)).withColumn("date_type", F.lit(date_type))
    series_text(out).write.mode(mode).partitionBy("source_type", "date_type").text(root)


# ---- city reference ---------------------------------------------------------------------------------------------

def parse_city_reference(lines: DataFrame) -> DataFrame:
    """Typed reference rows; lines with a ``fault`` are left out."""
    f = F.split(F.col("value"), "#", -1)
    return lines.where(fault("city").isNull()).select(
        F.get(f, F.lit(0)).alias("std_sta_num"),
        F.get(f, F.lit(1)).alias("city_id"),
        parse_qty(F.get(f, F.lit(2))).alias("ref_qty"),
        F.to_date(F.try_to_timestamp(F.get(f, F.lit(3)), F.lit("yyyy-MM-dd"))).alias("ref_start"),
    )


def one_per_city(ref: DataFrame) -> DataFrame:
    """The reference series of a city: one row per ``city_id`` (the smallest ``std_sta_num`` on duplicates).

    A ``min_by`` aggregate: partial per partition, so a city listed many times costs one row per partition.
    """
    return (ref.groupBy("city_id")
            .agg(F.min_by(F.struct("std_sta_num", "ref_qty", "ref_start"),
                          F.struct(F.col("std_sta_num").try_cast("bigint"), F.col("std_sta_num"))).alias("r"))
            .select("city_id", "r.std_sta_num", "r.ref_qty", "r.ref_start"))


def read_city_reference(spark: SparkSession, path: str) -> DataFrame:
    return one_per_city(parse_city_reference(spark.read.text(path)))


def city_reference_text(ref: DataFrame) -> DataFrame:
    qty_text = F.array_join(F.transform("ref_qty", lambda x: F.coalesce(x.cast("string"), F.lit(NULL_MARK))), ", ")
    return ref.select(F.concat_ws("#", "std_sta_num", "city_id", qty_text,
                                  F.date_format("ref_start", "yyyy-MM-dd")).alias("value"))
