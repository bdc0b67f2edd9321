"""Command line for the two daily jobs, submitted through the root launcher:

    spark-submit --py-files stationcast.zip run_stationcast.py train --as-of 2024-03-04 \\
        --series <root> --city-ref <path> --models <root>
    spark-submit --py-files stationcast.zip run_stationcast.py forecast --as-of 2024-03-04 \\
        --series <root> --city-ref <path> --models <root> --out <root> [--files 5]

The session comes from the submitting environment (master, executors, ``spark.checkpoint.dir``); nothing here
overrides cluster settings. ``--as-of`` is required: the wall clock is never read.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from ..params import Params
from ..sources import codes, series_text
from . import forecast_job, train_job


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="stationcast")
    ap.add_argument("job", choices=["train", "forecast"])
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="the run day T (yyyy-MM-dd)")
    ap.add_argument("--series", required=True, help="root of the series text table")
    ap.add_argument("--source-type", default=None, help="series partition (defaults per job)")
    ap.add_argument("--city-ref", required=True, help="city reference text path")
    ap.add_argument("--models", required=True, help="model store root (shared storage)")
    ap.add_argument("--out", help="report output root (forecast)")
    ap.add_argument("--rejects", help="folder for the input lines that cannot be read (not written without it)")
    ap.add_argument("--max-rejects", type=int, default=100, help="with --rejects, stop the job when more lines than this cannot be read")
    ap.add_argument("--files", type=int, default=5, help="report files (forecast)")
    ap.add_argument("--attempt", default=None, help="name of this training; one that broke off goes on under its name")
    ap.add_argument("--feature-store", default=None, help="folder in which trainings keep their features for the next one (train)")
    ap.add_argument("--base-deliver", default="Self", help="delivery type of the base class")
    ap.add_argument("--base-ord", default="Normal", help="order type of the base class")
    ap.add_argument("--city-by-own-offset", action="store_true", help="index the city series by the station's own offsets")
    ap.add_argument("--ratio-one-is-zero", action="store_true", help="a class ratio of exactly 1 allocates nothing")
    ap.add_argument("--train-fresh-dedupe", action="store_true", help="train on fresh, deduplicated series")
    ap.add_argument("--fallback-scale", choices=["volume", "crossmean"], default="volume")
    ap.add_argument("--max-iter", type=int, default=None, help="boosting rounds (default 1000)")
    ap.add_argument("--max-depth", type=int, default=None, help="tree depth (default 15)")
    return ap


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    p = Params(as_of=a.as_of, base_deliver=a.base_deliver, base_ord=a.base_ord, align_city_by_date=not a.city_by_own_offset,
               ratio_one_is_zero=a.ratio_one_is_zero, train_fresh_dedupe=a.train_fresh_dedupe, fallback_scale=a.fallback_scale)
    if a.max_iter is not None or a.max_depth is not None:
        import dataclasses

        g = dataclasses.replace(p.gbt, **{k: v for k, v in (("max_iter", a.max_iter), ("max_depth", a.max_depth))
                                          if v is not None})
        p = p.with_(gbt=g)
    source = p.train_source if a.job == "train" else p.forecast_source
    spark = SparkSession.builder.appName(f"stationcast-{a.job}").getOrCreate()
    ref = series_text.read_city_reference(spark, a.city_ref)
    if a.job == "forecast" and not a.out:
        raise SystemExit("--out is required for the forecast job")
    if a.rejects:
        for kind, lines in (("series", series_text.series_lines(spark, a.series, a.source_type or source, p.date_type)), ("city", spark.read.text(a.city_ref))):
            found = series_text.write_rejects(lines, f"{a.rejects.rstrip('/')}/{a.job}-{p.as_of.isoformat()}/{kind}", a.max_rejects, kind)
            print(f"{kind} lines that cannot be read: {found or 'none'}")
    if a.job == "train":
        series = series_text.read_series(spark, a.series, a.source_type or source, p.date_type)
        train_job.run(spark, series, ref, p, a.models, a.attempt, a.feature_store)
    else:
        series = series_text.read_series(spark, a.series, a.source_type or source, p.date_type)
        done = forecast_job.run_and_publish(spark, series, ref, codes.code_dim(spark), p, a.models, a.out, a.files)
        print(f"{done.lines} report lines in {done.path}, {done.unknown} with an unknown name")


if __name__ == "__main__":
    main()
