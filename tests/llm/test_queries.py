"""Every operator's query over tables full of awkward rows, held against plain versions; and over empty tables."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from stationcast.llm import queries as Q

from . import brute


def rows(spark, name, folder):
    return [r.asDict(recursive=True) for r in Q.REGISTRY[name](spark, folder).collect()]


def by_text(docs, made):
    """Results joined to texts by id (ids are unique but for one repeated row)."""
    text = {d["doc_id"]: d["text"] for d in docs}
    assert Counter(r["doc_id"] for r in made) == Counter(d["doc_id"] for d in docs)
    return [(r, text[r["doc_id"]]) for r in made]


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_empty_tables_give_no_rows(spark, empty_tables, name):
    assert rows(spark, name, empty_tables) == []


def test_near_duplicates(spark, docs, tables):
    want = brute.near_groups(docs)
    for r, text in by_text(docs, rows(spark, "op1_minhash_near_dedup", tables)):
        assert r["n_shingles"] == len(brute.shingle_set(text))
        assert r["component_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else None)
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_decontamination(spark, docs, tables):
    found = rows(spark, "op2_decontamination", tables)
    from .conftest import PASSAGE

    budget = int(0.1 * len(PASSAGE.encode()))
    want = {d["doc_id"]: brute.edit_match(brute.fold(PASSAGE), brute.fold(d["text"])) for d in docs}
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in found} == {
        (i, item, e) for i, e in want.items() if e <= budget for item in (1, 4)}
    for r in found:
        text = next(d["text"] for d in docs if d["doc_id"] == r["doc_id"])
        assert brute.edit_match(brute.fold(PASSAGE), brute.fold(text)[r["start"]:r["end"]]) == r["edits"]


def test_quality_rules(spark, docs, tables):
    for r, text in by_text(docs, rows(spark, "op3_quality_rules", tables)):
        got = tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute.quality_counts(text)
        assert 0 <= r["class_distance"] <= 1 and 0 <= r["word_distance"] <= 1
    kept = brute.quality_kept(docs)
    assert Counter((r["doc_id"], r["kept"]) for r in rows(spark, "op3_quality_rules", tables)) == Counter(
        (d["doc_id"], k) for d, k in zip(docs, kept, strict=True))
    assert 0 < sum(kept) < len(kept)


def test_byte_bpe(spark, docs, tables):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r, text in by_text(docs, rows(spark, "op4_byte_bpe", tables)):
        ids = library.encode_ordinary(text or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_toxicity(spark, docs, tables):
    from .conftest import TOXIC

    right = total = 0
    for r, text in by_text(docs, rows(spark, "op5_toxicity", tables)):
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (brute.crc(r["doc_id"], 4) == 2)
        if r["held_out"]:
            total += 1
            right += r["predicted"] == int(any(w in (text or "") for w in TOXIC))
    assert total > 15 and right / total > 0.75


def test_license_scan(spark, docs, tables):
    for r, text in by_text(docs, rows(spark, "op6_license_scan", tables)):
        assert tuple(r[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute.license_base(text)
        labels = set(filter(None, r["labels"].split(",")))
        assert labels == set(filter(None, r["base_labels"].split(","))) | {s["label"] for s in r["spans"]}
        assert ("apache-2.0" in labels) == ("icensed under the Apache" in (text or ""))
        assert r["score"] == (1.0 if r["n_base"] else max([0.0, *(0.5 for s in r["spans"])]) and r["score"])


def test_warc(spark, tables):
    pages = [r.asDict() for r in spark.read.parquet(f"{tables}/pages.parquet").collect()]
    last: dict[str, int] = {}
    for p in pages:
        if p["page_id"] is not None:
            last[p["html"] or ""] = max(last.get(p["html"] or "", -1), p["page_id"])
    want = []
    for p in pages:
        html = p["html"] or ""
        to = last.get(html)
        to = None if to is None or to == p["page_id"] else to
        want.append((str(p["page_id"]), len(html.encode()), brute.base32_sha1(html), "response" if to is None else "revisit", str(to)))
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]))
           for r in rows(spark, "op7_warc", tables)]
    assert sorted(got) == sorted(want)


def test_suffix_dedup(spark, docs, tables):
    want = dict(zip([d["doc_id"] for d in docs], brute.without_repeats([d["text"] for d in docs]), strict=True))
    for r, _ in by_text(docs, rows(spark, "op8_suffix_dedup", tables)):
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, removed, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_lm_scoring(spark, docs, tables):
    want: dict = {}
    for d, s in zip(docs, brute.base_scores(docs), strict=True):
        want[d["doc_id"]] = s
    model = base = 0.0
    for r, _ in by_text(docs, rows(spark, "op10_lm_scoring", tables)):
        held, n, known, total, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert abs(r["base_score"] - score) < 1e-6 * max(1, abs(score))
        assert r["score"] < 0
        if held:
            model, base = model + r["score"], base + r["base_score"]
    assert model > 1.02 * base  # the words of this corpus are independent, so pairs tell nothing; the mixture must not lose by it


def test_token_counts(spark, docs, tables):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    from stationcast.llm.token_counts import FLOOR

    m = proto.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type in (1, 4):
            p.score = max(p.score, FLOOR)
    library = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    for r, text in by_text(docs, rows(spark, "op9_token_counts", tables)):
        if len(text or "") < 3000:  # in longer texts the library's running single-precision sum loses ties
            assert r["n_tokens"] == len(library.encode(text or "")), text
        else:
            assert r["n_tokens"] > 0
