"""Training job: series -> feature table (written once, partitioned by feature day) -> binned rows -> one model per horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import feature_store as kept_features, models, series as ser, training
from ..params import Params
from ..session import scratch, stored


FILES_PER_DAY = 16


def write_feature_table(series: DataFrame, ref: DataFrame, p: Params, path: str, files_per_day: int = FILES_PER_DAY) -> str:
    """Materialise the feature table in the shared folder: row counts, cuts and binned rows all read it, so it is computed once.

    Partitioned by ``pre_end`` (62 days). Rows are hash-partitioned on the day
    and one of ``FILES_PER_DAY`` parts of the stations first: one pass over the features (a range partitioning would sample
    them, and so compute them twice), and a bounded number of files per day.
    """
    return _write(training.feature_table(series, ref, p), path, files_per_day)


def _write(table: DataFrame, path: str, files_per_day: int) -> str:
    (table.withColumn("_part", F.pmod(F.hash("sta_num"), F.lit(files_per_day))).repartition("pre_end", "_part").drop("_part")
     .write.mode("overwrite").partitionBy("pre_end").parquet(path))
    return path


def run(spark: SparkSession, series: DataFrame, ref: DataFrame, p: Params, model_root: str, attempt: str | None = None,
        feature_store: str | None = None) -> dict:
    """Train the per-horizon models, commit them under ``model_root`` and return their manifest. A run with the ``attempt`` name of one that
    broke off goes on from its last written rounds. With ``feature_store``, features of earlier trainings are taken from there and new ones
    are added; days that no later training reads are deleted. The intermediate tables are deleted at the end, however the job ends."""
    with scratch(spark) as folder:
        def table() -> str:
            cities = stored(ref, folder("city_reference"))      # measured for its join, then read by it
            if feature_store is None:
                return write_feature_table(ser.normalised(series), cities, p, folder("feature_table"))
            inputs = training.feature_inputs(ser.normalised(series), cities, p)
            rows = kept_features.feature_rows(inputs, p, feature_store, folder, FILES_PER_DAY)
            return _write(rows, folder("feature_table"), FILES_PER_DAY)

        found = models.fit_models(spark, table, p, model_root, attempt)
        if feature_store is not None:
            kept_features.drop_before(spark, feature_store, p)
        return found
