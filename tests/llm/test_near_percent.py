"""The pipeline's near-duplicate stage links from 80 % on; op1's query from 85 %."""

from __future__ import annotations

import corpus_pipeline as P
from stationcast.llm import near_duplicates

from . import brute


def near(n: int) -> list[dict]:
    """Pairs of 104 words, the second with its last ``k`` words changed: ``(100 - k) / (100 + k)`` of the shingles."""
    docs = []
    for i, k in enumerate(range(6, 16)):
        w = [f"w{n}x{i}x{j}" for j in range(104)]
        docs += [{"doc_id": 2 * i, "text": " ".join(w)}, {"doc_id": 2 * i + 1, "text": " ".join([*w[:-k], *[f"new{i}x{j}" for j in range(k)]])}]
    return docs


def test_stage_takes_pairs_between_80_and_85_percent(spark):
    docs = near(1)
    table = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string")
    kept = {r["doc_id"] for r in P.minhash_near_dedup(spark, table, "").collect()}
    at80, at85 = ({i for i, g in brute.near_groups(docs, x).items() if i == g} for x in (80, 85))
    assert kept == at80 and len(at85) - len(at80) == 3
    assert {r["doc_id"] for r in near_duplicates.groups(table).where("kept").collect()} == at85
