"""Registered queries: one per operator with a data output, each reading the driver tables of ``sf_dir``.

Every query starts from ``lineitem`` (through the series adapter), so its work grows with the data. Arrays
are emitted as exploded ``(…, idx, value)`` rows or scalars, doubles rounded to 6 places, so a long-form SQL
oracle can check them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import array_sum as _array_sum, clean_window as _clean_window, scale_crossmean as _crossmean
from ..functions import dates as _dates
from ..functions.arrays import py_slice as _py_slice
from ..functions.dates import window_bounds as _window_bounds
from ..operators import allocation, series as ser
from ..operators import evaluation as _evaluation, features as _features, report as _report
from ..operators import feature_store as _store, training as _training
from ..params import GbtParams as _Gbt
from ..params import Params
from ..sources import codes, tables
from ..sources import series_text as _text
from . import forecast_job as _fj, train_job as _tj

AS_OF = dt.date(2001, 11, 5)  # the day after the last ship date of the driver tables


def params() -> Params:
    return Params(as_of=AS_OF)


def _series(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """Series of the driver tables. The adapter always folds days onto the data's own last day (``AS_OF``);
    a back-test moves only the job's as-of day."""
    return tables.series_from_tables(spark, sf_dir, params())


def _clean_series(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """Fresh, one row per (station, delivery type, order type): the forecast job's input."""
    return _fj.clean_series(_series(spark, sf_dir, p), p, checkpoint=False)


KEY = ["sta_num", "deliver_type", "ord_type"]


def s1_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed series, exploded back to the days with a sale."""
    p = params()
    s = _series(spark, sf_dir, p)
    return (_features.posexplode_kept(s, "qty", "idx", "qty_v", *KEY, "start_date")
            .withColumnRenamed("qty_v", "qty")
            .where(F.col("qty") != 0)
            .select(*KEY, F.date_add("start_date", "idx").alias("ds"), "qty"))


def s1_series_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = _series(spark, sf_dir, p)
    return s.select(*KEY, "region_name", "area_id", "area_name", "sta_name", "province_id", "city_id", "county_id",
                    "start_date", F.size("qty").alias("n_days"))


def f3_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = ser.fresh(_series(spark, sf_dir, p), p)
    return s.select(*KEY, "start_date", F.size("qty").alias("n_days"), ser.missing_days(p).alias("missing_days"))


def f1_base_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = ser.base_class(_series(spark, sf_dir, p), p)
    return s.select(*KEY, "start_date", F.size("qty").alias("n_days"))


def f2_other_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = ser.other_classes(_series(spark, sf_dir, p), p)
    return s.select(*KEY, "start_date", F.size("qty").alias("n_days"))


def a1_dedupe_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = _clean_series(spark, sf_dir, p)
    return s.select(*KEY, "start_date", F.size("qty").alias("n_days"),
                    _array_sum(F.col("qty")).alias("qty_total"))


def a2_sum60(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    s = _clean_series(spark, sf_dir, p)
    return s.select(*KEY, allocation.sum_recent(p).alias("sum60"))


def j1_class_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    r = allocation.class_ratio(_clean_series(spark, sf_dir, p), p)
    return r.select(*KEY, "sum60", "base60", F.round("ratio", 6).alias("ratio"))


def p4_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery, order and region codes of every fresh series."""
    p = params()
    s = _clean_series(spark, sf_dir, p)
    dim = codes.code_dim(spark, tables.region_codes(spark, sf_dir))
    s = codes.encode(s, None, "deliver", "deliver_type", "fr_type")
    s = codes.encode(s, None, "ord", "ord_type", "ord_code")
    s = codes.encode(s, dim, "region", "region_name", "region_id")
    return s.select(*KEY, "region_name", "fr_type", "ord_code", "region_id")


REGISTRY = {
    "s1_series": s1_series,
    "s1_series_meta": s1_series_meta,
    "f1_base_class": f1_base_class,
    "f2_other_classes": f2_other_classes,
    "f3_fresh": f3_fresh,
    "a1_dedupe_longest": a1_dedupe_longest,
    "a2_sum60": a2_sum60,
    "j1_class_ratio": j1_class_ratio,
    "p4_encode": p4_encode,
}


# ---- windows and features -----------------------------------------------------------------------------------



def _inputs(spark, sf_dir, p):
    """Series built once and checkpointed (lineage cut in the shared checkpoint folder), and the city
    reference derived from it, checkpointed too: it is measured for its join and then read by it."""
    from ..session import shared_dir

    shared_dir(spark)  # makes sure a checkpoint folder is set (tests only set their own)
    s = _series(spark, sf_dir, p).checkpoint(eager=True)
    return s, tables.city_reference_from_tables(s, p).checkpoint(eager=True)


def _base_clean(spark, sf_dir, p, s=None):
    s = _series(spark, sf_dir, p) if s is None else s
    # nothing is pruned through the dedupe's struct, so only the columns that features read go into it
    s = s.select(*KEY, "start_date", "qty", *_features.ID_COLUMNS)
    return ser.base_class(_fj.clean_series(s, p, checkpoint=False), p)


def w1_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window bounds and own offsets at the forecast day."""
    p = params()
    pe = F.lit(p.forecast_pre_end)
    b = _window_bounds(pe, p)
    s = _base_clean(spark, sf_dir, p)
    return s.select(*KEY,
                    b["pre"][0].alias("pre_from"), b["pre"][1].alias("pre_to"),
                    b["his"][0].alias("his_from"), b["his"][1].alias("his_to"),
                    b["his_pre"][0].alias("his_pre_from"), b["his_pre"][1].alias("his_pre_to"),
                    F.datediff(b["pre"][0], "start_date").alias("pos_pre"),
                    F.datediff(b["his"][0], "start_date").alias("pos_his"),
                    F.datediff(b["his_pre"][0], "start_date").alias("pos_his_pre"),
                    F.datediff(F.lit(p.as_of), "start_date").alias("pos_today"))


def w3_clean_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three cleaned own windows of every fresh series at the forecast day (W3), exploded."""
    p = params()
    s = _clean_series(spark, sf_dir, p)
    pos = _features.positions(F.lit(p.forecast_pre_end), p)
    wins = F.array(*[F.struct(F.lit(name).alias("win"),
                              _clean_window(F.col("qty"), lo, hi).alias("vals"))
                     for name, (lo, hi) in pos.items()])
    return (s.select(*KEY, F.explode_outer(wins).alias("w"))
            .where(F.col("w.vals").isNotNull())
            .select(*KEY, "w.win", F.posexplode("w.vals").alias("idx", "value"))
            .select(*KEY, "win", "idx", F.round("value", 6).alias("value")))


def _forecast_features(spark, sf_dir, p):
    s, ref = _inputs(spark, sf_dir, p)
    return _features.forecast_features(_base_clean(spark, sf_dir, p, s), ref, p)


def w4_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 90 history features of every base series at the forecast day (W4-W6, F7-F12), exploded."""
    p = params()
    f = _forecast_features(spark, sf_dir, p)
    return (_features.posexplode_kept(f, "hist", "idx", "value", "sta_num", "path")
            .select("sta_num", "path", "idx", F.round("value", 6).alias("value")))


def w4_feature_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = params()
    f = _forecast_features(spark, sf_dir, p)
    return f.select("sta_num", "path", F.size("hist").cast("bigint").alias("n_values"))


REGISTRY.update({
    "w1_windows": w1_windows,
    "w3_clean_window": w3_clean_window,
    "w4_features": w4_features,
    "w4_feature_paths": w4_feature_paths,
})


# ---- training set --------------------------------------------------------------------------------------------



def w7_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label of every base series on each of the 28 label days, when positive."""
    p = params()
    first, last = _training.label_days(p)
    s = ser.base_class(_series(spark, sf_dir, p), p)
    days = s.withColumn("label_date", F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))))
    return (days.select("sta_num", "label_date", _training.label_at(F.col("label_date")).alias("label"))
            .where(F.col("label") > 0))


def j5_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows per horizon and label day (J5, M2): path, label and a digest of the 90 features."""
    p = params()
    s, ref = _inputs(spark, sf_dir, p)
    t = _training.training_rows(s, ref, p)
    return t.select("horizon", "label_date", "sta_num", "path", "label",
                    F.round(F.aggregate("hist", F.lit(0.0), lambda a, x: a + x), 6).alias("hist_sum"),
                    F.round(F.array_max("hist"), 6).alias("hist_max"),
                    F.round(F.element_at("hist", 1), 6).alias("hist_first"),
                    F.round(F.element_at("hist", -1), 6).alias("hist_last"))


def j5_training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every (series, feature day) used by the training set, exploded (W4-W6 at 62 days)."""
    p = params()
    s, ref = _inputs(spark, sf_dir, p)
    f = _features.history_features(_training.feature_days(_training.feature_inputs(s, ref, p), p), p)
    return (_features.posexplode_kept(f, "hist", "idx", "value", "sta_num", "pre_end", "path")
            .select("sta_num", "pre_end", "path", "idx", F.round("value", 6).alias("value")))


def j5_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of ``j5_training_features`` out of a feature store that last week's training filled: seven days and what changed are
    computed, the rest is read (J5, M2)."""
    from pyspark.ml.functions import vector_to_array

    from ..session import scratch, shared_dir, stored

    p, store = params(), shared_dir(spark, "feature_store")
    s, ref = _inputs(spark, sf_dir, p)
    with scratch(spark) as folder:
        series = stored(ser.base_class(s, p), folder("series"))         # read by both trainings
        cities = stored(ref, folder("city_reference"))
        for q in (p.with_(as_of=p.as_of - dt.timedelta(days=7)), p):
            rows = _store.feature_rows(_training.feature_inputs(series, cities, q), q, store, folder, _tj.FILES_PER_DAY)
        out = rows.select("sta_num", "pre_end", "path", F.slice(vector_to_array("features"), 1, 3 * p.window_len).alias("hist"))
        out = stored(out, shared_dir(spark, "feature_rows"))
    return (_features.posexplode_kept(out, "hist", "idx", "value", "sta_num", "pre_end", "path")
            .select("sta_num", "pre_end", "path", "idx", F.round("value", 6).alias("value")))


REGISTRY.update({
    "j5_feature_store": j5_feature_store,
    "w7_labels": w7_labels,
    "j5_training_set": j5_training_set,
    "j5_training_features": j5_training_features,
})


# ---- allocation, report, back-test, models --------------------------------------------------------------------



def _naive_allocated(spark, sf_dir, p):
    clean = _fj.clean_series(_series(spark, sf_dir, p), p)
    return _fj.allocated(clean, _fj.naive_forecasts(clean, p), p)


def r2_allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base forecast (seasonal-naive baseline) allocated to the other classes and capped (R2, R3), exploded."""
    p = params()
    a = _naive_allocated(spark, sf_dir, p).where(~F.col("is_base"))
    return (_features.posexplode_kept(a, "forecast", "h", "value", *KEY)
            .select(*KEY, "h", F.round("value", 6).alias("value")))


def r3_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per other class: whether the cap applied, and the scaled forecast total before it."""
    p = params()
    a = _naive_allocated(spark, sf_dir, p).where(F.col("allocation").isNotNull())
    return a.select(*KEY, F.round("allocation.scaled_total", 6).alias("scaled_total"),
                    F.round("allocation.recent35", 6).alias("recent35"), "allocation.capped")


def _naive_report(spark, sf_dir, p):
    clean = _fj.clean_series(_series(spark, sf_dir, p), p)
    codes_df = codes.code_dim(spark, tables.region_codes(spark, sf_dir))
    return _fj.build_report(clean, _fj.naive_forecasts(clean, p), codes_df, p)


def r4_report_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's value blocks (W9-W13, R4, R5), exploded to (block, part, idx, value)."""
    p = params()
    rep = _naive_report(spark, sf_dir, p)
    ids = [F.col("sta_num"), F.col("deliver_name").alias("deliver_type"), F.col("ord_name").alias("ord_type")]
    parts = []
    for block in ("current_block", "year_ago_block"):
        tag = "cur" if block == "current_block" else "ago"
        for i, name in enumerate(("recent", "forecast", "week_rest", "rolling")):
            parts.append(F.struct(F.lit(tag).alias("block"), F.lit(i).alias("part"),
                                  F.transform(F.col(block)[name], lambda x: x.cast("double")).alias("vals")))
    return (rep.select(*ids, F.explode_outer(F.array(*parts)).alias("b"))
            .where(F.col("b.vals").isNotNull())
            .select("sta_num", "deliver_type", "ord_type", "b.block", "b.part",
                    F.posexplode("b.vals").alias("idx", "value"))
            .select("sta_num", "deliver_type", "ord_type", "block", "part", "idx", F.round("value", 6).alias("value")))


def r6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report header columns per row (R6, R7: base and other classes together)."""
    p = params()
    rep = _naive_report(spark, sf_dir, p)
    return rep.select("region_id", "region_name", "area_id", "area_name", "sta_num", "sta_name", "data_date",
                      "next_monday", "fr_type", "ord_type", "delivered_flag",
                      F.col("deliver_name").alias("deliver_type"), F.col("ord_name").alias("ord_name"),
                      F.col("year_ago_block").isNotNull().alias("has_year_ago"))


def w8_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual quantities of the 35 days from a back-test day (``T - 35``), for complete series."""
    p = params().with_(as_of=AS_OF - dt.timedelta(days=35))
    a = _evaluation.actuals(_series(spark, sf_dir, p), p)
    return _features.posexplode_kept(a, "actual", "h", "actual", *KEY)


# Settings of the registered model queries: the method's own (1000 rounds of depth 15), never fewer. README, "Training time", has the
# measured figures.

QUERY_GBT = _Gbt()


def _trained(spark, sf_dir, p):
    """Train on the tables (models filed under this week's Sunday) and return inputs for scoring a week later."""
    from ..session import shared_dir

    s, ref = _inputs(spark, sf_dir, p)
    root = shared_dir(spark, "models")
    _tj.run(spark, s, ref, p, root)
    return s, ref, root


def m4_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35-day model forecast per station (M3-M6, A11): trained as of ``T - 7``, scored as of ``T``."""
    p = params().with_(gbt=QUERY_GBT)
    s, ref, root = _trained(spark, sf_dir, p.with_(as_of=p.as_of - dt.timedelta(days=7)))
    clean = _fj.clean_series(s, p)
    fc = _fj.model_forecasts(clean, ref, p, root)   # read back from the model store
    return _features.posexplode_kept(fc, "forecast", "h", "forecast", "sta_num")


def m4_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-test at ``T - 35``: per-horizon RMSE of the model, the seasonal-naive baseline and the recent-window
    mean baseline (W8, SURVEY 5.5)."""
    p = params().with_(as_of=AS_OF - dt.timedelta(days=35), gbt=QUERY_GBT)
    s, ref, root = _trained(spark, sf_dir, p.with_(as_of=p.as_of - dt.timedelta(days=7)))
    clean = _fj.clean_series(s, p)
    model_fc = _fj.model_forecasts(clean, ref, p, root)
    naive_fc = _fj.naive_forecasts(clean, p)
    later = ser.dedupe_longest(ser.normalised(s), KEY)      # the days from the as-of day on, which ``clean`` has not
    act = _evaluation.actuals(ser.base_class(later, p), p).select("sta_num", "actual")
    m = _evaluation.rmse(model_fc, act).withColumnsRenamed({"rmse": "rmse_model", "rmse_sold": "rmse_model_sold"})
    b = _evaluation.rmse(naive_fc, act).select("horizon", F.col("rmse").alias("rmse_naive"))
    pre = _evaluation.pre_mean_forecast(_features.forecast_features(ser.base_class(clean, p), ref, p), p)
    c = _evaluation.rmse(pre, act).select("horizon", F.col("rmse").alias("rmse_pre_mean"), F.col("rmse_sold").alias("rmse_pre_mean_sold"))
    return m.join(b, "horizon").join(c, "horizon", "left")


def r7_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published text lines of the model forecast run."""
    p = params().with_(gbt=QUERY_GBT)
    s, ref, root = _trained(spark, sf_dir, p.with_(as_of=p.as_of - dt.timedelta(days=7)))
    codes_df = codes.code_dim(spark, tables.region_codes(spark, sf_dir))
    rep = _fj.run(spark, s, ref, codes_df, p, root)
    return _report.report_text(rep)


def r7_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text lines of the report of the seasonal-naive forecast (R7, S3), character by character."""
    return _report.report_text(_naive_report(spark, sf_dir, params()))


def s3_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That report published (dated folder, file count, codec, overwrite) and read back: lines, files and deflate files
    (S3-S6)."""
    from ..session import shared_dir

    p = params()
    rep = _naive_report(spark, sf_dir, p)
    root = shared_dir(spark, "report")
    _report.publish(rep.limit(0), root, p)
    path = _report.publish(rep, root, p).path
    back = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    return back.agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("value").alias("n_distinct"),
                    F.countDistinct("file").alias("n_files"),
                    F.countDistinct(F.when(F.col("file").endswith(".txt.deflate"), F.col("file"))).alias("n_deflate"))


def a7_crossmean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of all pairwise ratios of a base series' year-ago and recent windows."""
    p = params()
    pos = _features.positions(F.lit(p.forecast_pre_end), p)
    s = _base_clean(spark, sf_dir, p)
    part = lambda name: F.when((pos[name][0] >= 0) & (pos[name][1] >= 0), F.filter(
        _py_slice(F.col("qty"), *pos[name]), lambda x: x.isNotNull()))
    return (s.select("sta_num", F.round(_crossmean(part("his"), part("pre")), 6).alias("scale"))
            .where(F.col("scale").isNotNull()))


def m5_m6_model_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every ship date as a run day, the dates of the models it trains and of those it reads (M5, M6)."""
    day = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("as_of")).distinct()
    return day.select("as_of", _dates.training_day(F.col("as_of")).alias("train_date"), _dates.forecast_day(F.col("as_of")).alias("read_date"))


def m1_feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector's length and its three ids per base station (M1); a blank id counts as 0."""
    from pyspark.ml.functions import vector_to_array

    f = _features.with_feature_vector(_forecast_features(spark, sf_dir, params()))
    v = vector_to_array("features")
    return f.select("sta_num", F.size(v).cast("bigint").alias("n"), *[v[90 + i].alias(c) for i, c in enumerate(("province", "city", "county"))])


REGISTRY.update({
    "r7_report_lines": r7_report_lines,
    "s3_publish": s3_publish,
    "a7_crossmean": a7_crossmean,
    "m5_m6_model_dates": m5_m6_model_dates,
    "m1_feature_vector": m1_feature_vector,
    "r2_allocate": r2_allocate,
    "r3_cap": r3_cap,
    "r4_report_blocks": r4_report_blocks,
    "r6_report": r6_report,
    "w8_actuals": w8_actuals,
    "m4_forecast": m4_forecast,
    "m4_backtest": m4_backtest,
    "r7_report_text": r7_report_text,
})


# ---- text sources (the published input formats) -------------------------------------------------------------------



def s1_series_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series written in the packed text format (two source types) and read back with partition pruning
    (S1, P1-P3): the forecast source's rows, one summary row per series."""
    from ..session import shared_dir

    p = params()
    root = shared_dir(spark, "series_text")
    s = _series(spark, sf_dir, p)
    _text.write_series(s, root, p.forecast_source)
    _text.write_series(ser.base_class(s, p), root, p.train_source, mode="append")
    back = _text.read_series(spark, root, p.forecast_source, p.date_type)
    return back.select(*KEY, "region_name", "city_id", "start_date", F.size("qty").alias("n_days"),
                       _array_sum(F.col("qty")).alias("qty_total"))


def j3_city_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City reference written as ``#`` text and read back, one row per city."""
    from ..session import shared_dir

    p = params()
    path = shared_dir(spark, "city_reference")
    rows = tables.city_reference_rows(_series(spark, sf_dir, p), p)      # a city is listed once per full-length station
    _text.city_reference_text(rows).write.mode("overwrite").text(path)
    r = _text.read_city_reference(spark, path)
    return r.select("city_id", "std_sta_num", "ref_start", F.size("ref_qty").alias("n_days"),
                    _array_sum(F.col("ref_qty")).alias("qty_total"))


REGISTRY.update({"s1_series_text": s1_series_text, "j3_city_ref": j3_city_ref})


# ---- per-operator views named as in the blueprint -------------------------------------------------------------------

def _features_on_path(path: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return w4_features(spark, sf_dir).where(F.col("path") == path)
    q.__doc__ = f"Feature values of the stations on the ``{path}`` path at the forecast day."
    return q


w4_features_own = _features_on_path("own")
w5_features_city = _features_on_path("city")
w6_features_fallback = _features_on_path("fallback")


def w9_rolling7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine rolling 7-day sums of the current block."""
    b = r4_report_blocks(spark, sf_dir)
    return b.where((F.col("block") == "cur") & (F.col("part") == 3)).select(*KEY, "idx", "value")


def w12_year_ago(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year-ago block: 60 / 28 / rest-of-week days and its rolling sums."""
    b = r4_report_blocks(spark, sf_dir)
    return b.where(F.col("block") == "ago").select(*KEY, "part", "idx", "value")


def j5_training_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (horizon, label day) of the training set."""
    t = j5_training_set(spark, sf_dir)
    return t.groupBy("horizon", "label_date").agg(F.count(F.lit(1)).alias("n_rows"),
                                                  F.sum("label").alias("label_total"))


REGISTRY.update({
    "w4_features_own": w4_features_own,
    "w5_features_city": w5_features_city,
    "w6_features_fallback": w6_features_fallback,
    "w9_rolling7": w9_rolling7,
    "w12_year_ago": w12_year_ago,
    "j5_training_grid": j5_training_grid,
})
