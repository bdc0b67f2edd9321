"""The queries that SQL can express against DuckDB, over the awkward tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from stationcast.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, tables, empty_tables, name):
    for folder in (tables, empty_tables):
        con = duckdb.connect()
        for t in ("documents", "pages", "labels", "benchmark", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        sql = con.execute(Q.SQL[name])
        names = [c[0] for c in sql.description]
        want = Counter(tuple(map(repr, r)) for r in sql.fetchall())
        made = Q.REGISTRY[name](spark, folder)
        assert sorted(made.columns) == sorted(names)
        assert Counter(tuple(map(repr, r)) for r in made.select(*names).collect()) == want
