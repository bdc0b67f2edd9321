"""Benchmark: the headline queries at ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``.

Each query is planned and run to completion with the ``noop`` sink (no rows pulled to the driver). Prints a JSON line after each
query, over all that have ended, so the last line holds whatever a stopped bench has measured:
``{"metric", "value" (sum of query seconds), "unit", "queries": {name: sec}, "sf", "ended", "of"}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationcast.plans import queries as q  # noqa: E402
from stationcast.session import local_session  # noqa: E402

HEADLINE = [
    "s1_series_meta",      # scan lineitem, join, aggregate, pack daily series
    "j1_class_ratio",      # freshness, dedupe, 60-day sums, ratio join
    "w4_features",         # the three feature paths at the forecast day
    "j5_training_set",     # 62 feature days x 35 horizons x 28 label days
    "r2_allocate",         # allocation with cap
    "r4_report_blocks",    # report value blocks
    "r7_report_text",      # the whole job: train 35 models at the full settings, forecast, allocate, report (by far the longest)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="stationcast-bench")
    # warm the JVM and the parquet footers once, untimed
    q.f1_base_class(spark, sf_dir).write.format("noop").mode("overwrite").save()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = q.REGISTRY[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(json.dumps({"metric": "headline_queries_total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                          "sf": float(m.group(1)) if m else sf_dir, "ended": len(times), "of": len(names),
                          "gbt": {"max_iter": q.QUERY_GBT.max_iter, "max_depth": q.QUERY_GBT.max_depth}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
