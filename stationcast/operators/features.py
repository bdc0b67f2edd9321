"""History features (W1-W6, F7-F12, J3, A8, M1): 90 cleaned daily values + 3 location ids per (series, day).

A feature row is a series row plus ``pre_end``, the exclusive end of its recent window. Three windows of
``window_len`` days are cut at fixed distances before ``pre_end`` (``functions.dates.window_bounds``); each path
below is a chain of built-in array expressions on the row, so the whole computation is row-local.

* ``own``: the station's own three windows, outliers replaced (``clean_window``).
* ``city``: a young station (start after ``new_station_threshold``) takes the windows from its city's
  reference series.
* ``fallback``: when a window cannot be used, the station's raw recent window is followed by the reference
  series' year-ago windows rescaled to the station's volume.

Rows without a full set of 90 values are dropped.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import array_sum, clean_window, let, py_slice, scale_crossmean
from ..functions.dates import WINDOWS, window_bounds
from ..params import Params
from .joins import lookup

ID_COLUMNS = ("province_id", "city_id", "county_id")


def attach_city_reference(df: DataFrame, ref: DataFrame, measured: bool = True) -> DataFrame:
    """Left-join the city reference (one row per city) on ``city_id``.

    The reference has one row per city, but each row holds a whole series, so it is broadcast only when its
    measured size fits the session's broadcast threshold (``measured``). Beyond it, cities with very many stations are
    salted by station (``joins.lookup``). Without ``measured`` the planner decides.
    """
    r = ref.select("city_id", "std_sta_num", "ref_qty", "ref_start")
    return lookup(df, r, "city_id", "sta_num", ("ref_qty",)) if measured else df.join(r, "city_id", "left")


def positions(pre_end: Column, p: Params) -> dict[str, tuple[Column, Column]]:
    """Own offsets ``[lo, hi)`` of the three windows in a series that starts on ``start_date``."""
    return {name: (F.datediff(lo, "start_date"), F.datediff(hi, "start_date"))
            for name, (lo, hi) in window_bounds(pre_end, p).items()}


def _no_nulls(arr: Column) -> Column:
    return ~F.exists(arr, lambda x: x.isNull())


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Rows where ``cond`` holds, filtered above a generator.

    A plain ``where`` on a freshly computed column is pushed below the projection with the column's whole
    expression copied into it, which evaluates the feature arrays twice. A filter on a generator's output
    cannot move below the generator; ``explode_outer`` is used because Spark infers (and pushes down) a
    ``size(...) > 0`` filter for a plain ``explode``.
    """
    return (df.withColumn("_keep", F.explode_outer(F.when(cond, F.array(F.lit(True)))))
            .where(F.col("_keep")).drop("_keep"))


def posexplode_kept(df: DataFrame, arr: str, pos: str, val: str, *keep: str) -> DataFrame:
    """``posexplode`` of a computed array without the inferred pushdown filter (see ``keep_rows``): rows of a
    NULL or empty array produce nothing, as with ``posexplode``."""
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, val))
            .where(F.col(pos).isNotNull()))


def _fallback(pos: dict, p: Params) -> Column:
    """Raw own recent window ++ the reference's year-ago windows divided by the volume ratio, or NULL."""
    shift = F.datediff("start_date", "ref_start")
    ref_his_lo, ref_hp_lo = pos["his"][0] + shift, pos["his_pre"][0] + shift
    ref_pre = py_slice(F.col("ref_qty"), pos["pre"][0] + shift, pos["pre"][1] + shift)
    parts = F.struct(py_slice(F.col("qty"), *pos["pre"]).alias("own"), ref_pre.alias("rpre"),
                     py_slice(F.col("ref_qty"), ref_his_lo, pos["his"][1] + shift).alias("his"),
                     py_slice(F.col("ref_qty"), ref_hp_lo, pos["his_pre"][1] + shift).alias("hp"))

    def build(b):
        own_sum = array_sum(b["own"])
        if p.fallback_scale == "crossmean":
            # Mean pairwise ratio of the reference's and the station's recent windows
            div = F.coalesce(scale_crossmean(b["rpre"], b["own"]), F.lit(0.0))
        else:
            # divisor = sum(reference year-ago-pre window) / sum(own recent window); 0 when the station sold
            # nothing
            div = F.when(own_sum != 0, array_sum(b["hp"]).cast("double") / own_sum.cast("double")).otherwise(
                F.lit(0.0))

        def scaled(d):
            return F.concat(
                F.transform(b["own"], lambda x: x.cast("double")),
                F.transform(b["his"], lambda x: F.when(d != 0, x.cast("double") / d).otherwise(F.lit(1.0))),
                F.transform(b["hp"], lambda x: F.when(d != 0, x.cast("double") / d).otherwise(F.lit(1.0))))

        usable = ((F.size(b["own"]) >= p.window_len)
                  & _no_nulls(b["own"]) & _no_nulls(b["his"]) & _no_nulls(b["hp"]))
        return F.when(usable, let(div, scaled))

    # days before the series or the reference starts are missing, not wrapped around (Q7)
    ok = F.col("ref_qty").isNotNull() & (pos["pre"][0] >= 0) & (ref_his_lo >= 0) & (ref_hp_lo >= 0)
    return F.when(ok, let(parts, build))


def _source(p: Params) -> tuple[Column, Column, Column]:
    """Whether the station is young, the array its windows are cut from, and what is added to its own offsets."""
    young = F.col("start_date") > F.lit(p.new_station_threshold)
    src = F.when(young, F.col("ref_qty")).otherwise(F.col("qty"))
    shift = (F.when(young, F.datediff("start_date", "ref_start")).otherwise(F.lit(0))
             if p.align_city_by_date else F.lit(0))
    return young, src, shift


def input_signature(p: Params) -> Column:
    """64-bit hash of all that ``with_history`` and ``id_values`` read of a row. Rows of a station and ``pre_end`` with equal
    signatures have equal features, whatever the as-of day; a restated day, another reference or a station that stops being young
    gives another one."""
    pos = positions(F.col("pre_end"), p)
    young, src, shift = _source(p)
    to_ref = F.datediff("start_date", "ref_start")
    cut = ([py_slice(src, lo + shift, hi + shift) for lo, hi in pos.values()] + [py_slice(F.col("qty"), *pos["pre"])]
           + [py_slice(F.col("ref_qty"), lo + to_ref, hi + to_ref) for lo, hi in pos.values()])
    read = ([F.array_join(a.cast("array<string>"), ",", "n") for a in cut]
            + [(x >= 0).cast("string") for lo, hi in pos.values() for x in (lo, hi, lo + to_ref)]
            + [young.cast("string"), F.col("ref_qty").isNull().cast("string")] + [F.col(c).cast("string") for c in ID_COLUMNS])
    rule = f"{p.window_len} {p.cycle_len} {p.align_city_by_date} {p.fallback_scale}"
    return F.xxhash64(F.lit(rule), *[x for r in read for x in (r.isNull(), r)])


def history_features(df: DataFrame, p: Params) -> DataFrame:
    """Add ``path`` and ``hist`` (``ARRAY<DOUBLE>``, 90 values) to rows with ``start_date``, ``qty``, ``pre_end``
    and the city reference columns; rows that get no valid history are dropped."""
    return keep_rows(with_history(df, p), valid_history(F.col("hist"), p))


def valid_history(hist: Column, p: Params) -> Column:
    return hist.isNotNull() & (F.size(hist) == len(WINDOWS) * p.window_len)


def with_history(df: DataFrame, p: Params) -> DataFrame:
    """``history_features`` of every row: ``hist`` is NULL or too short where there is no valid history."""
    pos = positions(F.col("pre_end"), p)
    young, src, shift = _source(p)
    staged = df
    for i, name in enumerate(WINDOWS):
        lo, hi = pos[name]
        # an own window end before the start fails (F12); the source may be the city series
        staged = staged.withColumn(f"_w{i}", F.when((lo >= 0) & (hi >= 0), clean_window(src, lo + shift, hi + shift)))
    w = [F.col(f"_w{i}") for i in range(len(WINDOWS))]
    all_ok = F.coalesce(w[0].isNotNull() & w[1].isNotNull() & w[2].isNotNull()
                        & (~young | F.col("ref_qty").isNotNull()), F.lit(False))
    return (staged
              .withColumn("path", F.when(all_ok, F.when(young, F.lit("city")).otherwise(F.lit("own")))
                          .otherwise(F.lit("fallback")))
              .withColumn("hist", F.when(all_ok, F.concat(*w)).otherwise(_fallback(pos, p)))
              .drop(*[f"_w{i}" for i in range(len(WINDOWS))]))


def id_values() -> Column:
    """(province, city, county) as doubles. An id that is no number counts as 0."""
    return F.array(*[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in ID_COLUMNS])


def with_feature_vector(df: DataFrame, out: str = "features") -> DataFrame:
    """``hist`` ++ (province, city, county) as doubles, as an ML vector (M1)."""
    return df.withColumn(out, array_to_vector(F.concat(F.col("hist"), id_values())))


FEATURE_INPUT = ["sta_num", "start_date", "qty", "province_id", "city_id", "county_id"]


def forecast_features(series: DataFrame, ref: DataFrame, p: Params, measured: bool = True) -> DataFrame:
    """Feature rows as of ``p.as_of`` (``pre_end = T - 8``) for the given (base-class) series, pruned to the
    columns the features need."""
    rows = attach_city_reference(series.select(*FEATURE_INPUT).withColumn("pre_end", F.lit(p.forecast_pre_end)),
                                 ref, measured)
    return history_features(rows, p)
