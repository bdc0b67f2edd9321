"""The registered queries against their DuckDB long-form oracle on the smallest driver tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FAST = ["s1_series", "f3_fresh", "a1_dedupe_longest", "j1_class_ratio", "p4_encode", "w3_clean_window",
        "w4_features", "w7_labels", "j5_training_set", "r2_allocate", "r3_cap", "r4_report_blocks", "r6_report",
        "w8_actuals", "w6_features_fallback", "w9_rolling7", "j5_training_grid"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in ("region", "nation", "supplier", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
