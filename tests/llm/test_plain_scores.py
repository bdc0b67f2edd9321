"""op5 and op10 row by row against dictionary versions of their models."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stationcast.llm import interpolated_lm as L
from stationcast.llm import toxicity as X

from . import brute
from .conftest import TOXIC, prose


def grams(text: str | None) -> set[int]:
    """Slots of a text: its 4- to 7-byte strings, each hashed by itself."""
    b = b" " + re.sub(rb"[\x09-\x0D]", b" ", brute.lower(text)) + b" "
    return {((int.from_bytes(b[i:i + k], "little") + k) * int(X.GOLDEN) & ((1 << 64) - 1)) >> (64 - X.SLOT_BITS)
            for k in X.GRAMS for i in range(len(b) - k + 1)}


def plain_toxicity(texts: list[str | None], learned: list[tuple[str | None, int]]) -> list[float]:
    sets = [(grams(t), y) for t, y in learned]
    toxic = sum(y for _, y in sets)
    other = len(sets) - toxic
    q, p = Counter(), Counter()
    for s, y in sets:
        (p if y else q).update(s)
    ratio = {}
    for s in p.keys() | q.keys():
        r = math.log((p[s] + 1) / (toxic + 2)) - math.log((q[s] + 1) / (other + 2))
        if abs(r) * math.sqrt(p[s] + 1) > X.LEAST_Z:
            ratio[s] = r
    names = sorted(ratio)
    assert names
    x = np.array([[ratio[n] if n in s else 0.0 for n in names] + [1.0] for s, _ in sets])
    y = np.array([y for _, y in sets], float)
    w, ridge = np.zeros(len(names) + 1), np.append(np.full(len(names), X.REGULARISATION), 0.0)
    for _ in range(100):                                        # Newton steps on the mean log loss with the ridge
        z = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve(x.T @ (x * (z * (1 - z))[:, None]) / len(y) + np.diag(ridge), x.T @ (z - y) / len(y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-12:
            break
    return [1 / (1 + math.exp(-sum(w[i] * ratio[n] for i, n in enumerate(names) if n in s) - w[-1])) for s in map(grams, texts)]


def test_toxicity_equals_the_dictionary_version(spark, monkeypatch):
    rng = random.Random(21)
    texts = [prose(rng, 25) + (f" {rng.choice(TOXIC)} " + prose(rng, 4) if k % 3 == 0 else "") for k in range(150)]
    learned = [(t, int(any(w in t for w in TOXIC))) for t in texts[:120]]
    learned[5] = (learned[5][0], 1)
    monkeypatch.setattr(X, "LEAST_Z", 4.0)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(learned)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(learned)], "doc_id long, toxic int")
    every = [*texts, None, "", "IDIOT\tScum", "x"]
    model = X.train(docs, labels)
    want = plain_toxicity(every, learned)
    scored = X.score(spark.createDataFrame(list(enumerate(every)), "doc_id long, text string"), model)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert len(got) == len(every)
    assert max(abs(got[i] - w) for i, w in enumerate(want)) < 2e-3
    assert min(want) < 0.2 and max(want) > 0.8


def plain_interpolation(texts: list[str | None], learn: list[bool]) -> list[float]:
    tokens = [["<begin>", *brute.lower(t).split(), "<end>"] for t in texts]
    one, context, two = Counter(), Counter(), Counter()
    for ts, own in zip(tokens, learn, strict=True):
        if own:
            one.update(ts[1:])
            context.update(ts[:-1])
            two.update(zip(ts[:-1], ts[1:], strict=True))
    n, v = sum(one.values()), len(one)
    # c(v) of a word counts it everywhere, as c(w) does; of the begin mark, once a text
    seen = lambda t: context[t] if t == "<begin>" else one[t]
    bucket = lambda c: c.bit_length()
    share = lambda a, b: a / b if b else 0.0
    held: dict[int, list] = {}
    for ts, own in zip(tokens, learn, strict=True):
        if own:
            mine, pairs = Counter(ts[1:]), Counter(zip(ts[:-1], ts[1:], strict=True))
            before = Counter(ts[:-1])
            for a, b in zip(ts[:-1], ts[1:], strict=True):
                c = seen(a) - before[a]
                held.setdefault(bucket(c), []).append((share(two[a, b] - pairs[a, b], c), share(one[b] - mine[b], n - len(ts) + 1), 1 / (v + 1)))

    def fit(rows):
        p, a = np.array(rows), np.full(3, 1 / 3)
        for _ in range(L.ROUNDS):
            part = a * p
            a = (part / part.sum(axis=1)[:, None]).mean(axis=0)
        return a

    weights = {b: fit(rows) for b, rows in held.items()}
    rest = fit([r for rows in held.values() for r in rows])
    out = []
    for ts in tokens:
        total = 0.0
        for a, b in zip(ts[:-1], ts[1:], strict=True):
            w = weights.get(bucket(seen(a)), rest)
            total += math.log10(w[0] * share(two[a, b], seen(a)) + w[1] * one[b] / n + w[2] / (v + 1))
        out.append(total)
    return out


@pytest.mark.parametrize("paired", [False, True])
def test_language_model_equals_exact_expectation_maximisation(spark, paired):
    """The grid of quarter octaves against EM on the estimates themselves."""
    rng = random.Random(22)
    texts: list[str | None] = [prose(rng, rng.randrange(3, 80)) for _ in range(60)] + [None, "", "one", "new words only"]
    if paired:
        texts += [" ".join(f"a{k % 7} b{k % 7}" for k in rng.sample(range(50), 20)) for _ in range(40)]
    texts += texts[:3]
    learn = [i % 5 != 1 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, learn, strict=True))], "doc_id long, text string, learn boolean")
    got = {r["doc_id"]: r["score"] for r in L.score(docs, ["doc_id"], "learn").collect()}
    want = plain_interpolation(texts, learn)
    sizes = [len(brute.lower(t).split()) + 1 for t in texts]
    assert len(got) == len(texts)
    assert max(abs(got[i] - w) / n for i, (w, n) in enumerate(zip(want, sizes, strict=True))) < 0.02
    assert abs(sum(got.values()) - sum(want)) < 0.002 * abs(sum(want))
