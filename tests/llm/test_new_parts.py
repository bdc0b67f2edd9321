"""Sharding, hard negatives and prefix tries against plain versions, with the parameters that make the hard cases small."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stationcast.llm import hard_negatives as H
from stationcast.llm import prefix_trie as T
from stationcast.llm import sharding as S

from .conftest import talk_rows


def capacity(sizes: list[int], shards: int) -> int:
    """The least largest sum of a cut of ``sizes`` into ``shards`` runs, by dynamic programming."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    best = list(map(int, ends))
    for _ in range(shards - 1):
        best = [min(max(best[j], int(ends[i] - ends[j])) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("probes", [7, 31])
def test_plan_is_the_least_largest_cut(spark, probes):
    rng = random.Random(probes)
    texts = [f"text {i} " * rng.randrange(1, 40) for i in range(60)] + ["twice " * 30] * 9
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    facts = S.facts(docs)
    plan = S.plan(facts, 5, probes)
    groups = Counter()
    for t in texts:
        groups[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 1
    sizes = [b for _, b in sorted(groups.items())]
    assert not plan.alone and plan.capacity == capacity(sizes, 5)
    held = Counter()
    for r in facts.withColumn("shard", S.shard_of(facts["gkey"], plan)).collect():
        held[r["shard"]] += r["size"]
    assert set(held) == set(range(5)) and max(held.values()) == plan.capacity


def test_a_group_over_its_share_is_a_shard_by_itself_and_the_rest_stays_even(spark):
    texts = ["x" * 999] * 40 + ["y" * 599] * 30 + [f"small {i:04d} " * 5 for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = S.shards(docs).collect()
    held, by_text = Counter(), defaultdict(set)
    for r in rows:
        held[r["shard"]] += r["size"]
        by_text[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values()) and by_text["x" * 999] == {0}
    rest = [held[i] for i in range(2, 8)]
    assert held[0] == 40_000 and held[1] == 18_000 and max(rest) - min(rest) <= 0.02 * max(rest)
    for shard in range(8):
        mine = sorted((r["slot"], r["doc_id"]) for r in rows if r["shard"] == shard)
        assert [s for s, _ in mine] == list(range(len(mine))) and [d for _, d in mine] == sorted(d for _, d in mine)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)


def test_fewer_groups_than_shards_and_one_row_a_third_of_all(spark):
    docs = spark.createDataFrame([(1, "one")] * 30 + [(2, None), (3, ""), (None, "four")], "doc_id long, text string")
    rows = S.shards(docs).collect()
    assert len(rows) == 33 and {r["shard"] for r in rows if r["doc_id"] == 1} == {0}
    assert sorted(r["slot"] for r in rows if r["doc_id"] == 1) == list(range(30))
    assert len({r["shard"] for r in rows if r["doc_id"] in (2, 3)}) == 1


def mined(rows: list[tuple]) -> Counter:
    """The hard negatives by scoring all pairs with Python integers."""
    known = [(v, (lab + 1) % 10 if v % 7 == 0 else lab, [math.floor(256 * x) for x in q]) for v, q, lab in rows]
    out = Counter()
    for i, (v, lab, q) in enumerate(known):
        if v % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, p, strict=False)), w, j, other) for j, (w, other, p) in enumerate(known) if j != i), key=lambda s: s[:3])
        for s, w, _, _ in [x for x in scored if x[3] == lab][:5]:
            fit = [x for x in scored if x[3] != lab and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out.update((v, w, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fit))
    return out


@pytest.mark.parametrize("case", ["clustered", "lengths", "large", "ties"])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, case):
    rng = random.Random(case)
    scale = 1e6 if case == "large" else 1.0
    centres = [[rng.gauss(0, scale) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(400):
        q = [c + rng.gauss(0, 0.2 * scale) for c in centres[i % 6]]
        if case == "ties":
            q = [float(round(x)) for x in q]
        rows.append((i, q[:rng.randrange(1, 13)] if case == "lengths" else q, rng.randrange(4)))
    monkeypatch.setattr(H, "LEAST_BLOCK", 64)                      # several cells
    monkeypatch.setattr(H, "BLOCK", 64)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = Counter(tuple(r) for r in H.mine(table).select(*names).collect())
    assert got == mined(rows) and got


def test_scores_beyond_64_bits_are_clipped(spark):
    rows = [(i, [1e30 + i, 1e-30], i % 2) for i in range(60)]
    got = H.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert all(r["positive_score"] == 2**63 - 1 for r in got)


def test_bounds_hold_every_score(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) + 3 * (i % 3)], 1) for i in range(300)]
    t = H.indexed(H.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))).toArrow()
    block, anchors = H.Side(t), H.Side(t.slice(0, 50))
    starts, low, high = H.bounds(anchors, block, 16)
    scores = anchors.q @ block.q.T
    window = np.searchsorted(starts, np.arange(300), "right") - 1
    assert (scores >= low[:, window]).all() and (scores <= high[:, window]).all()
    assert (high < scores.max(axis=1)[:, None]).mean() > 0.2       # some windows are ruled out


def plain_trie(rows: list[dict]) -> Counter:
    """The nodes by grouping all prefixes."""
    own = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, code, (role, text)))
    turns = {c: [x[3] for x in sorted(t, key=lambda x: x[:3])] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + t[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


@pytest.mark.parametrize("ranges", [1, 8, 60])
def test_trie_equals_all_prefixes_however_it_is_split(spark, monkeypatch, ranges):
    monkeypatch.setattr(T, "PIECE", 3)
    rows = talk_rows()
    table = spark.createDataFrame([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows], "conv_id long, turn long, role string, text string")
    paths = T.rebuilt(table)
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = Counter(tuple(r) for r in T.nodes(paths).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
    assert got == plain_trie(rows)


def test_trie_of_one_path_and_of_turnless_conversations(spark):
    paths = spark.createDataFrame([(5, b""), (3, b"")], "conv_id long, path binary")
    [r] = T.nodes(paths).collect()
    assert (r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) == (3, 0, None, 2, 0, 1, 0)
    assert r["ends_sha256"] == hashlib.sha256(b"3,5").hexdigest()


def test_double_array_keeps_every_child_apart():
    rng = np.random.default_rng(1)
    paths = sorted({tuple(rng.integers(1, 30, rng.integers(1, 6)).tolist()) for _ in range(3000)})
    off = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    codes = np.array([c for p in paths for c in p])
    trie = T.pack(codes, off, 29)
    seen: dict[int, tuple] = {}
    for d, live, state in T.walk(trie, codes, off):
        for i, s in zip(live.tolist(), state.tolist(), strict=True):
            assert seen.setdefault(s, paths[i][:d]) == paths[i][:d]
    assert len(seen) == len({p[:d] for p in paths for d in range(len(p) + 1)})
    assert trie.end < 3 * len(seen) + 100
