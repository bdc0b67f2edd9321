"""The pipeline, stage by stage and as a whole, against plain versions over the awkward tables."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from stationcast.llm.common import table, written

from . import brute
from .conftest import PASSAGE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def key(d: dict) -> tuple:
    return tuple(d[c] for c in COLUMNS)


def plain(docs: list[dict]) -> list[list[dict]]:
    """What each stage but the last keeps."""
    good = [d for d, k in zip(docs, brute.quality_kept(docs), strict=True) if k]
    group = brute.near_groups(good, P.NEAR_PERCENT)
    seen, alone = set(), []
    for d in good:
        if d["doc_id"] is None or (group[d["doc_id"]] == d["doc_id"] and d["doc_id"] not in seen):
            seen.add(d["doc_id"])
            alone.append(d)
    cut = []
    for d, (_, _, _, kept) in zip(alone, brute.without_repeats([d["text"] for d in alone]), strict=True):
        text = kept.decode("utf-8", "ignore")
        cut.append(d | {"text": text, "n_chars": len(text)})
    budget = int(0.1 * len(PASSAGE))
    near = brute.fold(PASSAGE)
    clean = [d for d in cut if len(d["text"]) > 4000 or brute.edit_match(near, brute.fold(d["text"])) > budget]
    return [good, alone, cut, clean]


def test_stages_and_run(spark, docs, tables):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "byte_level_bpe"]
    now = table(spark, tables, "documents")
    names = now.columns
    sizes = [len(docs)]
    for (name, stage), want in zip(P.STAGES[:-1], plain(docs), strict=True):
        now = written(stage(spark, now, tables), name)
        assert now.columns == names
        assert Counter(key(r.asDict()) for r in now.collect()) == Counter(map(key, want)), name
        sizes.append(len(want))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((d["doc_id"], tuple(library.encode_ordinary(d["text"]))) for d in plain(docs)[-1])
    rows = P.run(spark, tables).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in rows)


def test_empty_documents(spark, empty_tables):
    assert P.run(spark, empty_tables).collect() == []
