"""Kernels and operators' own interfaces, without a query around them."""

from __future__ import annotations

import gzip
import random

import numpy as np
import pyarrow as pa
import pytest

from stationcast.llm import blocks, byte_bpe, interpolated_lm, repeats, superminhash, text_arrays, token_counts, warc


def test_words_and_hashes_match_python():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB é\t\n 日x") for _ in range(rng.randrange(60))) for _ in range(200)] + ["w" * 300, "", " "]
    seen: dict[bytes, int] = {}
    for c in text_arrays.chunks(pa.array(texts), 500):
        data = text_arrays.lowered(c.data)
        w = text_arrays.words(data, c.off)
        h = text_arrays.word_hashes(data, w)
        for d in range(len(c.off) - 1):
            want = texts[c.lo + d].encode().lower().split()
            lo, hi = w.off[d], w.off[d + 1]
            assert [data[a:b].tobytes() for a, b in zip(w.start[lo:hi], w.end[lo:hi], strict=True)] == want
            for word, x in zip(want, h[lo:hi].tolist(), strict=True):
                assert seen.setdefault(word, x) == x
    assert len(set(seen.values())) == len(seen)


def _superminhash_plain(s, m):
    """The published loop, element by element, with the same draws."""
    sig = [superminhash.EMPTY] * m
    for e in s:
        perm = list(range(m))
        for j in range(m):
            value, k = superminhash._draw(np.array([e], np.uint64), j, m)
            k = int(k[0])
            perm[j], perm[k] = perm[k], perm[j]
            sig[perm[j]] = min(sig[perm[j]], int(value[0]))
    return sig


def test_superminhash_equals_the_elementwise_algorithm():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 2, 7, 40, 200)]
    got = superminhash.signatures(sets, 24)
    for s, row in zip(sets, got, strict=True):
        assert row.tolist() == _superminhash_plain(s, 24)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**63, 400).astype(np.uint64)
    y = np.concatenate([x[:360], rng.integers(0, 2**63, 40).astype(np.uint64)])
    a, b = superminhash.signatures([np.sort(x), np.sort(y)], 1024 // 4)
    assert abs((a == b).mean() - 360 / 440) < 0.1


def test_squeezed_arrays_round_trip():
    rng = np.random.default_rng(5)
    x = np.sort(rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    assert (blocks.expand_sorted(blocks.squeeze_sorted(x)) == x).all()
    assert (blocks.expand(blocks.squeeze(x[::-1])) == x[::-1]).all()
    assert len(blocks.expand(blocks.squeeze(x[:0]))) == 0


@pytest.mark.parametrize("size,gram", [(3, 1), (8, 4), (20, 20)])
def test_spans_hold_every_window_once(size, gram):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(30)]
    for c in text_arrays.chunks(pa.array(texts)):
        s = repeats.spans(c, repeats.Hashes(c.data), size, gram)
        at = repeats._windows(s, np.arange(len(s.lo))).tolist()
        assert sorted(at) == [a + i for a, b in zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True) for i in range(b - a - size + 1)]


def test_repeats_of_small_windows(spark):
    from . import brute

    rng = random.Random(7)
    texts = ["".join(rng.choice("abcé") for _ in range(rng.randrange(80))) for _ in range(40)] + [None, "", "a" * 50]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = brute.without_repeats(texts, 8)
    packed = blocks.pack(docs.repartition(5), 200)
    answers, removed = repeats.removals(packed, 8, 3)

    def run(rows, totals, _):
        return pa.table({"doc_id": rows["doc_id"], "n": pa.array(
            [int(x) for d, g in removed(rows, totals) for x in np.diff(np.concatenate([[0], np.cumsum(g)])[d.off])], pa.int64())})

    got = {r["doc_id"]: r["n"] for r in blocks.answered(packed, answers, run, "doc_id long, n long").collect()}
    assert got == {i: w[1] for i, w in enumerate(want)}


def test_merge_replay_on_odd_words():
    ranks = {bytes([b]): b for b in range(256)}
    for i, t in enumerate([b"ab", b"bc", b"abc", b"aa", b"aaa", b"cab", b"aaaa", b"bca"]):
        ranks[t] = 256 + i
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    v = byte_bpe.Vocabulary(ranks, r"\S+")
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))).encode() for _ in range(3000)] + [b"a" * n for n in range(1, 60)]
    for w, ids in zip(words, v.replay(words), strict=True):
        assert ids == library.encode_ordinary(w.decode())
        assert b"".join(v.bytes[i] for i in ids) == w


def test_viterbi_against_all_segmentations():
    v = token_counts.build({"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "▁a": -3.5, "ba": -1.0, "aba": -4.5}, True)
    floor = v.unknown

    def best(text):
        score, start, n = {0: 0.0}, {}, {0: 0}
        for s in range(len(text)):
            options = [(len(p), x) for p, x in (("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -3.5), ("ba", -1.0), ("aba", -4.5))
                       if text.startswith(p, s)]
            options.sort()
            if all(k != 1 for k, _ in options):
                options.append((1, None))
            for k, x in options:
                t = score[s] + (floor if x is None else x)
                if s + k not in score or t > score[s + k]:
                    score[s + k], start[s + k] = t, s
                    n[s + k] = n[s] + (1 if x is not None else len(text[s].encode()))
        return n[len(text)]

    rng = random.Random(3)
    for _ in range(500):
        text = "▁" + "".join(rng.choice("aabbé") for _ in range(rng.randrange(9)))
        assert token_counts.count(v, text) == best(text)


def test_em_weights_raise_the_likelihood():
    rng = np.random.default_rng(1)
    cells = [(int((b * interpolated_lm.LEVELS + two) * interpolated_lm.LEVELS + one), int(c))
             for b, two, one, c in zip(rng.integers(0, 5, 60), rng.integers(0, 200, 60), rng.integers(1, 200, 60), rng.integers(1, 50, 60), strict=True)]
    middle = lambda q: (q - interpolated_lm.LEVELS // 2 + 0.5) / interpolated_lm.OCTAVE * interpolated_lm.FINE
    w = interpolated_lm.learn_weights(pa.table({
        "cell": [c for c, _ in cells], "n": [n for _, n in cells],
        "two": [int(n * middle(c // interpolated_lm.LEVELS % interpolated_lm.LEVELS)) for c, n in cells],
        "one": [int(n * middle(c % interpolated_lm.LEVELS)) for c, n in cells]}))
    assert w.shape == (interpolated_lm.BUCKETS, 3) and np.allclose(w.sum(axis=1), 1) and (w > 0).all()

    def likelihood(weights):
        total = 0.0
        for cell, c in cells:
            b, two, one = cell // interpolated_lm.LEVELS**2, cell // interpolated_lm.LEVELS % interpolated_lm.LEVELS, cell % interpolated_lm.LEVELS
            p = [2.0 ** ((q - interpolated_lm.LEVELS // 2 + 0.5) / interpolated_lm.OCTAVE) if q else 0.0 for q in (two, one)]
            total += c * np.log(weights[b] @ np.array([*p, 1.0]))
        return total

    assert likelihood(w) > likelihood(np.full((interpolated_lm.BUCKETS, 3), 1 / 3))


def test_normaliser_makes_members_that_stand_alone(spark, tables):
    from pyspark.sql import functions as F

    from stationcast.session import shared_dir

    pages = spark.read.parquet(f"{tables}/pages.parquet").where("page_id is not null").dropDuplicates(["page_id"])
    folder = shared_dir(spark, "warc-test")
    rows = warc.with_targets(pages, "page_id", "html")
    made = warc.write(rows, f"{folder}/one", 3, F.col("page_id"), F.col("url"), F.col("html"), F.col("refers_to"))
    index = warc.normalise(made, f"{folder}/many")
    assert made.agg(F.sum("n_records")).first()[0] == index.count() == pages.count()
    whole = sorted((r["record_id"], r["record_type"], r["refers_to"], bytes(r["block"])) for r in warc.read(made).collect())
    assert whole == sorted((r["record_id"], r["record_type"], r["refers_to"], bytes(r["block"])) for r in warc.read(index).collect())
    assert whole == sorted((r["record_id"], r["record_type"], r["refers_to"], bytes(r["block"])) for r in warc.read_at(index).collect())
    for path, entries in ((r["archive"], r["e"]) for r in index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("e")).collect()):
        with open(path.removeprefix("file:"), "rb") as f:
            raw = f.read()
        assert sum(e["length"] for e in entries) == len(raw)
        for e in entries:
            assert gzip.decompress(raw[e["offset"]:e["offset"] + e["length"]]).startswith(b"WARC/1.1\r\n")
