"""Write the formatted physical plans of the key queries to ``docs/plans/`` (sf0.01 tables)."""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stationcast.plans import queries as q  # noqa: E402
from stationcast.session import local_session  # noqa: E402

NAMES = ["s1_series_meta", "j1_class_ratio", "w4_features", "j5_training_set", "r4_report_blocks"]


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    spark = local_session(8)
    out = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out, exist_ok=True)
    for name in NAMES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.REGISTRY[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue().replace(sf_dir, "<sf_dir>")
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(text)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
