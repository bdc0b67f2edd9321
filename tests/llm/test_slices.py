"""A benchmark of several slices against one of one slice."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from stationcast.llm import decontaminate as D

from .conftest import prose


@pytest.fixture()
def benchmark_and_docs(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 25)) for i in range(12)] + [(None, prose(rng, 25)), (20, None), (21, ""), (22, "short")]
    items += [(30, items[0][1]), items[1]]                     # the same passage under another id, and a repeated row
    texts: list[str | None] = [None, "", "nothing here", prose(rng, 3000) + " " + items[5][1]]
    texts += [prose(rng, 20) + " " + t.replace("the", "teh", 1) + " " + items[(k + 1) % 12][1].upper() for k, (_, t) in enumerate(items[:13])]
    rows = [(i, t, "own", "own") for i, t in enumerate(texts)] + [(100 + i, texts[6], "copy", "own") for i in range(40)] + [(None, texts[7], None, None)]
    return (spark.createDataFrame(items, "item_id long, text string"),
            spark.createDataFrame(rows, "doc_id long, text string, sha string, matches string"))


def test_slices_find_what_one_slice_finds(spark, benchmark_and_docs):
    benchmark, docs = benchmark_and_docs

    def found(**options):
        out = D.annotate(docs, benchmark, **options)
        assert out.columns == ["doc_id", "text", "sha", "matches"]      # the documents' own column of that name goes, others stay
        return sorted((str(r["doc_id"]), r["sha"] or "", str(sorted(map(tuple, r["matches"]), key=str))) for r in out.collect())

    one = found()
    assert sum(r[2] != "[]" for r in one) > 50
    assert found(slice_bytes=600) == one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(slice_bytes=900) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_documents_stay_and_nothing_is_found_in_an_empty_table(spark, benchmark_and_docs):
    benchmark, docs = benchmark_and_docs
    kept = D.decontaminate(docs, benchmark, slice_bytes=500)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
    assert D.contaminated(docs.where("false"), benchmark, slice_bytes=500).count() == 0
    assert D.decontaminate(docs, benchmark.where("false"), slice_bytes=500).count() == docs.count()


def test_cells_that_do_not_fit_64_bits_are_numbered_anew(monkeypatch):
    rng = random.Random(4)
    items = [(i, prose(rng, 30).encode()) for i in range(5)]
    column = pa.array([prose(rng, 10) + items[k % 5][1].decode() for k in range(20)])
    plain = D.PassageIndex(items).matches(column)
    assert all(plain)
    monkeypatch.setattr(D, "LARGEST", 1)
    assert D.PassageIndex(items).matches(column) == plain
