"""Series derived from the driver's TPC-H-style tables (FIXTURES.md section 3).

One station per supplier, one city per nation, one province per region. Every order line counts exactly once: ship dates are
folded onto the station's own span of days (``end - datediff(last, ship) % span``), so a short history holds the same quantity as a
long one. Stations differ by ``s_suppkey % 10`` (``Kind``), so that every path of the method is met: young, stale and newborn series,
two series of one class, the base class in another spelling, no base class, unknown days, a blank location id; and one city
has no reference. The work grows with ``lineitem``: one scan of six columns, a partial-then-final aggregation per station, class and
day, and a packing step that groups at most ``fold_days`` rows per series; suppliers are joined to the packed series only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Params
from .codes import REGION_CODES
from .series_text import SERIES_COLUMNS, one_per_city

FOLD_DAYS = 500
# Class names of the return flag and, per station, of the line status.
DELIVER_OF_FLAG = [("A", "Self"), ("N", "FBP"), ("R", "3rd")]
OPEN_ORDERS = ["Fresh1", "Fresh2", "Direct", "Frozen", "DeepFrozen"]
# Station kinds by s_suppkey % 10.
YOUNG, STALE, NEWBORN, RESPELLED, DOUBLED, NO_BASE, UNKNOWN_DAYS = 3, 4, 5, 6, 7, 8, 9
FULL = (0, 1, 2)
# Spans in days, and the days between the end of a stale series and the as-of day.
YOUNG_SPAN, STALE_SPAN, NEWBORN_SPAN, RESPELLED_SPAN, DOUBLED_SPAN, STALE_END = 415, 381, 200, 250, 300, 120
UNKNOWN_EVERY, UNKNOWN_AT = 97, 13
BLANK_COUNTY = 11          # s_suppkey % 20
NO_REFERENCE_CITY = 7      # n_nationkey


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(pairs, col: str):
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), F.col(col))


def densify(days: Column, n_days: Column) -> Column:
    """Dense daily array from ``(o, qty)`` entries sorted by offset ``o``: each entry becomes the zeros of the
    gap before it plus its value, then the pieces are flattened and the tail is zero-filled. Linear in the
    series length (a map lookup per day would scan the map each time)."""
    zero = F.lit(0).cast("bigint")
    pieces = F.transform(days, lambda e, j: F.concat(
        F.array_repeat(zero, (e["o"] - F.when(j == 0, F.lit(0)).otherwise(F.element_at(days, j)["o"] + 1)).cast("int")),
        F.array(e["qty"])))
    last = F.element_at(days, -1)["o"]
    return F.concat(F.flatten(pieces), F.array_repeat(zero, (n_days - last - 1).cast("int")))


def _span(kind: Column, copy: Column) -> Column:
    """Days of a series; second copies are shorter."""
    return (F.when((kind == RESPELLED) & (copy == 2), RESPELLED_SPAN).when((kind == DOUBLED) & (copy == 2), DOUBLED_SPAN)
            .when(kind == YOUNG, YOUNG_SPAN).when(kind == STALE, STALE_SPAN).when(kind == NEWBORN, NEWBORN_SPAN)
            .otherwise(FOLD_DAYS))


def daily_quantities(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """``(sta, kind, copy, deliver_type, ord_type, start_date, span, o, qty)``: sums per station, class and day ``o`` days after the
    start. The sum of ``qty`` is the sum of ``l_quantity``."""
    last = F.lit(p.yesterday)
    li = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
                                                  F.to_date("l_shipdate").alias("ship"))
    kind = F.col("l_suppkey") % 10
    copy = F.when(kind.isin(RESPELLED, DOUBLED) & (F.col("l_linenumber") == 1), 2).otherwise(1)
    deliver = F.when((kind == NO_BASE) & (F.col("l_returnflag") == "A"), "FBP").otherwise(_lookup(DELIVER_OF_FLAG, "l_returnflag"))
    other = F.element_at(F.array(*[F.lit(x) for x in OPEN_ORDERS]), (F.floor(F.col("l_suppkey") / 10) % len(OPEN_ORDERS) + 1).cast("int"))
    order = F.when(F.col("l_linestatus") == "F", "Normal").otherwise(other)
    rows = (li.withColumn("sta", F.col("l_suppkey").cast("bigint")).withColumn("kind", kind.cast("int")).withColumn("copy", copy)
            .withColumn("deliver_type", deliver).withColumn("ord_type", order).withColumn("span", _span(kind, copy)))
    end = F.when(F.col("kind") == STALE, F.lit(p.as_of - dt.timedelta(days=STALE_END))).otherwise(last)
    respelled = (F.col("kind") == RESPELLED) & (F.col("copy") == 2)
    return (rows.withColumn("start_date", F.date_sub(end, F.col("span") - 1))
            .withColumn("o", (F.col("span") - 1 - F.datediff(last, "ship") % F.col("span")).cast("int"))
            .withColumn("deliver_type", F.when(respelled & (F.col("deliver_type") == "Self"), "自营").otherwise(F.col("deliver_type")))
            .withColumn("ord_type", F.when(respelled & (F.col("ord_type") == "Normal"), "普通").otherwise(F.col("ord_type")))
            .groupBy("sta", "kind", "copy", "deliver_type", "ord_type", "start_date", "span", "o")
            .agg(F.sum("l_quantity").cast("bigint").alias("qty")))


def series_from_tables(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """Typed series rows (``SERIES_COLUMNS``), one per station, class and copy that has any sale."""
    # At most FOLD_DAYS rows per series: the group is bounded by the calendar, not by the data volume.
    packed = (daily_quantities(spark, sf_dir, p).groupBy("sta", "kind", "copy", "deliver_type", "ord_type", "start_date", "span")
              .agg(F.array_sort(F.collect_list(F.struct("o", "qty"))).alias("days")))
    packed = packed.withColumn("qty", densify(F.col("days"), F.col("span"))).drop("days")
    packed = packed.withColumn("qty", F.when(F.col("kind") == UNKNOWN_DAYS, F.transform("qty", lambda x, i: F.when(
        ~((x == 0) & (i % UNKNOWN_EVERY == UNKNOWN_AT)), x))).otherwise(F.col("qty")))
    supplier = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("sta"), F.col("s_nationkey").alias("n_nationkey"))
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions at every scale factor: broadcast. Suppliers grow: the
    # planner picks broadcast or shuffle from their size, and the other side has one row per series.
    out = (packed.join(supplier, "sta").join(F.broadcast(nation), "n_nationkey").join(F.broadcast(region), "n_regionkey"))
    names = [n for n, _ in REGION_CODES]
    region_name = F.coalesce(F.get(F.array(*[F.lit(x) for x in names]), (F.col("n_nationkey") % 8).cast("int")), F.col("r_name"))
    sta, city = F.col("sta").cast("string"), F.col("n_nationkey").cast("string")
    return out.select(
        F.concat(F.lit("t"), F.col("copy")).alias("tag"), "deliver_type", "ord_type", region_name.alias("region_name"),
        city.alias("area_id"), F.col("n_name").alias("area_name"), sta.alias("sta_num"), F.concat(F.lit("S"), sta).alias("sta_name"),
        F.col("n_regionkey").cast("string").alias("province_id"), city.alias("city_id"),
        F.when(F.col("sta") % 20 == BLANK_COUNTY, "").otherwise(sta).alias("county_id"),
        F.lit(p.date_type).alias("date_unit"), "start_date", F.size("qty").cast("string").alias("history_len"),
        F.lit("1").alias("unit_len"), F.lit("").alias("time_span"), "qty", F.lit("").alias("remark"),
    ).select(*SERIES_COLUMNS)


def city_reference_rows(series: DataFrame, p: Params) -> DataFrame:
    """``(city_id, std_sta_num, ref_qty, ref_start)``: the base series of every full-length station, so a city is listed more than
    once, and one city not at all."""
    from ..operators.series import base_class

    sta = F.col("sta_num").cast("bigint")
    full = base_class(series, p).where((sta % 10).isin(*FULL) & (F.col("city_id") != str(NO_REFERENCE_CITY)))
    return full.select("city_id", F.col("sta_num").alias("std_sta_num"), F.col("qty").alias("ref_qty"), F.col("start_date").alias("ref_start"))


def city_reference_from_tables(series: DataFrame, p: Params) -> DataFrame:
    """The reference of each city: one row, the series of its smallest full-length station."""
    return one_per_city(city_reference_rows(series, p))


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code rows for this dataset's region names: ``code = r_regionkey + 1``."""
    return _table(spark, sf_dir, "region").select(
        F.lit("region").alias("kind"), F.col("r_name").alias("alias"),
        (F.col("r_regionkey") + 1).cast("string").alias("code"))
