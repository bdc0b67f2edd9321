"""Counting over a corpus in one and in several levels, against a plain counter."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stationcast.llm import blocks as B
from stationcast.llm import repeats

from . import brute
from .conftest import prose

SPREAD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def test_levels_reach_all_blocks():
    assert [B.levels(n, 10) for n in (0, 1, 2, 10, 11, 100, 101, 1000)] == [(1, 1), (1, 1), (1, 2), (1, 10), (2, 4), (2, 10), (3, 5), (3, 10)]
    for n in (4096, 4097, 10**5, 1 << 24):
        deep, fan = B.levels(n)
        assert fan ** deep >= n and fan <= B.FAN and deep == (1 if n <= 4096 else 2)


def rows_of(spark, values, tmp_path):
    """Blocks of a few rows each, as ``pack`` makes them; a row is one number."""
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(5)
    return B.pack(df, block_bytes=16 * 4)


@pytest.mark.parametrize("most", [100_000, 8, 3, 2])
def test_counts_by_levels(spark, tmp_path, most):
    rng = random.Random(7)
    values = [rng.choice([1, 2, 3]) if rng.random() < 0.4 else rng.randrange(40) for _ in range(150)]
    packed = rows_of(spark, values, tmp_path)
    assert packed.n > 30

    def ask(rows, _):
        keys, counts = np.unique((rows["x"].to_numpy().astype(np.uint64) * np.uint64(SPREAD)), return_counts=True)
        return {0: (keys, counts.astype(np.uint64)), 5: (keys[:1], np.array([2], np.uint64))}

    def again(rows, totals):
        keys, counts = ask(rows, {})[0]
        keep = totals[0] > 10
        return {1: (keys[keep], counts[keep])}

    def read(rows, totals, block):
        keys, _ = ask(rows, {})[0]
        often = iter(totals.get(1, np.zeros(0)).tolist())
        out = [(block, k, t, next(often) if t > 10 else None, totals[5][0] if i == 0 else None)
               for i, (k, t) in enumerate(zip(keys.tolist(), totals[0].tolist(), strict=True))]
        return pa.table([pa.array([r[i] if i != 1 else str(r[i]) for r in out], t) for i, t in enumerate(
            [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], names=["block", "key", "total", "often", "least"])

    first = B.count(packed, ask, most=most)
    answers = B.merged(first, B.count(packed, again, first, most=most))
    want = Counter(str(v * SPREAD & MASK) for v in values)
    got = B.answered(packed, answers, read, "block long, key string, total long, often long, least long").collect()
    assert {r["key"] for r in got} == set(want) and len({r["block"] for r in got}) == packed.n
    assert all(r["total"] == want[r["key"]] and r["often"] == (r["total"] if r["total"] > 10 else None) for r in got)
    least = Counter()
    for r in got:
        if r["least"] is not None:
            least[r["key"]] += 2
    assert all(r["least"] in (None, least[r["key"]]) for r in got)
    assert B.stats(answers, 0) == (len(want), len(values)) and B.stats(answers, 5)[1] == 2 * packed.n
    deep, fan = B.levels(packed.n, most)
    assert first.table.groupBy("block", "kind").count().agg({"count": "max"}).first()[0] <= fan and (deep > 1) == (most < packed.n)


def test_repeats_do_not_depend_on_levels(spark, monkeypatch):
    rng = random.Random(8)
    shared = prose(rng, 60)
    texts = [prose(rng, 40) + " " + (shared if k % 3 == 0 else "") + prose(rng, 20) for k in range(24)] + [None, "", "x" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(B, "FAN", 2)
    monkeypatch.setattr(B.pack, "__defaults__", (600,))
    got = {r["doc_id"]: r["text"] for r in repeats.without_repeats(df).collect()}
    want = brute.without_repeats(texts)
    assert {i: (got[i] or "").encode() for i in got} == {i: w[3].decode(errors="ignore").encode() for i, w in enumerate(want)}
