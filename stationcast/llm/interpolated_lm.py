"""Deleted-interpolation bigram language model.

Tokens of a text: its words (white space ``\\x20\\x09-\\x0D`` between them, A-Z lower-cased), then one end token. With ``v`` the
token before ``w`` (a begin mark before the first),

    P(w | v) = a2(b) c(v, w) / c(v)  +  a1(b) c(w) / N  +  a0(b) / (V + 1)

over the training documents, where ``b`` is the bucket of the context's frequency c(v): 0, 1, 2-3, 4-7, ... The weights
of each bucket are learned by expectation-maximisation on held-out counts: each training document in turn is deleted
from the counts that predict it. For that, tokens are tallied in a grid of bucket and quarter-octave ratios of the two
estimates to the uniform one; the grid has a fixed number of cells whatever the corpus, so the tally fits the driver. Each cell
also adds up the logarithms of its ratios, so it enters the maximisation with its own geometric means, not with its middle.

Counts are exact (keys are 64-bit hashes of words and word pairs) and cover all training documents; nothing is pruned.

Defined cases: a NULL or empty text is the end token alone; a NULL ``learn`` flag counts as training; a repeated row counts
and is scored again; without training documents N = V = 0 and every token has probability 1; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from .text_arrays import GOLDEN, U, Docs, chunks, lowered, mix, word_hashes, words

END, BEGIN = U(0x0DDC0FFEE0DDF00D), U(0x0123456789ABCDEF)
ONE, TWO = 1, 2
OCTAVE = 4
LEVELS = 240          # quarter octaves of a ratio, 0 for an estimate of 0
FINE = 1 << 16        # units of an octave in the sums of logarithms
BUCKETS = 48
ROUNDS = 60


def _tokens(docs: Docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: token hashes, the hash before each, and its document."""
    data = lowered(docs.data)
    w = words(data, docs.off)
    h = word_hashes(data, w)
    n = np.diff(w.off)
    ends = np.cumsum(n + 1) - 1
    token = np.empty(len(h) + len(n), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end], token[~is_end] = END, h
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[np.concatenate([[0], ends[:-1] + 1])] = BEGIN
    return token, before, np.repeat(np.arange(len(n)) + docs.lo, n + 1)


def _all_tokens(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [_tokens(c) for c in chunks(rows["text"])]
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def _pair(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(before) * U(3) + token * GOLDEN)


def _learn(rows: pa.Table) -> np.ndarray:
    return rows["learn"].fill_null(True).to_numpy(zero_copy_only=False).astype(bool)


def _weighed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[at], np.add.reduceat(weight[order].astype(np.int64), at)


def _ask(rows: pa.Table, _) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    token, before, doc = _all_tokens(rows)
    learn = _learn(rows)
    begins = np.full(len(learn), BEGIN)
    return {ONE: _weighed(np.concatenate([token, begins]), np.concatenate([learn[doc], learn])),
            TWO: _weighed(_pair(before, token), learn[doc])}


def _looked_up(keys: np.ndarray, wanted: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return totals[np.searchsorted(keys, wanted)].astype(np.int64)


def _counts(rows: pa.Table, totals: dict[int, np.ndarray]):
    """For each token of a block: c(w), c(v), c(v, w), its document, and the keys for the deletion."""
    token, before, doc = _all_tokens(rows)
    asked = _ask(rows, {})
    one = lambda x: _looked_up(asked[ONE][0], x, totals[ONE])
    return token, before, doc, one(token), one(before), _looked_up(asked[TWO][0], _pair(before, token), totals[TWO])


def _own(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each token's key occurs in its own document."""
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
    n = np.diff(np.append(np.flatnonzero(new), len(k)))
    out = np.empty(len(k), np.int64)
    out[order] = n[np.cumsum(new) - 1]
    return out


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _ratio(p: np.ndarray, uniform: float) -> tuple[np.ndarray, np.ndarray]:
    """The level of each estimate's ratio to the uniform one, and its logarithm in units of ``FINE``."""
    with np.errstate(divide="ignore"):
        octaves = np.where(p > 0, np.log2(p / uniform), 0.0)
    level = np.clip(np.floor(OCTAVE * octaves) + LEVELS // 2, 1, LEVELS - 1)
    return np.where(p > 0, level, 0).astype(np.int64), np.rint(octaves * FINE)


def _safe(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _grid(n: int, v: int):
    def tally(rows: pa.Table, totals: dict[int, np.ndarray], _: int) -> pa.Table:
        token, before, doc, cw, cv, cvw = _counts(rows, totals)
        learn = _learn(rows)
        at = np.flatnonzero(learn[doc])
        token, before, doc, cw, cv, cvw = (x[at] for x in (token, before, doc, cw, cv, cvw))
        length = np.bincount(doc, minlength=len(learn))[doc]
        own_v = _own(before, doc)
        cvw, cw, cv = cvw - _own(_pair(before, token), doc), cw - _own(token, doc), cv - own_v
        two, two_log = _ratio(_safe(cvw, cv), 1 / (v + 1))
        one, one_log = _ratio(_safe(cw, n - length), 1 / (v + 1))
        at = (_bucket(cv) * LEVELS + two) * LEVELS + one
        count = np.bincount(at)
        cell = np.flatnonzero(count)
        add = lambda x: pa.array(np.bincount(at, weights=x)[cell].astype(np.int64), pa.int64())
        return pa.table([pa.array(cell, pa.int64()), pa.array(count[cell], pa.int64()), add(two_log), add(one_log)], names=["cell", "n", "two", "one"])
    return tally


def learn_weights(cells: pa.Table, rounds: int = ROUNDS) -> np.ndarray:
    """``(buckets, 3)``: the weights of the pair, word and uniform estimates, by expectation-maximisation over ``cell, n, two, one`` (the
    last two: sums of logarithms). A bucket without held-out tokens takes the weights of all tokens together."""
    cell, n, two, one = (cells[c].to_numpy() for c in ("cell", "n", "two", "one"))
    count, bucket = n.astype(np.float64), cell // (LEVELS * LEVELS)
    value = lambda level, log: np.where(level > 0, 2.0 ** (log / count / FINE), 0.0)
    p = np.stack([value(cell // LEVELS % LEVELS, two), value(cell % LEVELS, one), np.ones(len(cell))], axis=1)

    def fit(at: np.ndarray) -> np.ndarray:
        a = np.full(3, 1 / 3)
        for _ in range(rounds):
            part = a * p[at]
            part *= (count[at] / part.sum(axis=1))[:, None]
            a = part.sum(axis=0) / count[at].sum()
        return np.maximum(a, 1e-9) / np.maximum(a, 1e-9).sum()

    every = fit(np.arange(len(cell))) if len(cell) else np.full(3, 1 / 3)
    return np.array([fit(at) if len(at := np.flatnonzero(bucket == b)) else every for b in range(BUCKETS)])


SCORED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                       T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                       T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, id_columns: list[str], learn: str) -> DataFrame:
    """``id_columns`` of ``docs`` and ``n_tokens, n_known, train_tokens, base_score, score`` (log10 probabilities) of its
    ``text``; the model learns from the rows where ``learn`` is true."""
    packed = B.pack(docs.select(*id_columns, "text", F.col(learn).alias("learn")))
    answers = B.count(packed, _ask, name="lm_counts")
    n_types, n_tokens = B.stats(answers, ONE)
    begins = docs.where(F.coalesce(F.col(learn), F.lit(True))).count()
    n, v = n_tokens - begins, n_types - (begins > 0)
    grid = B.answered(packed, answers, _grid(n, v), "cell long, n long, two long, one long")
    cells = grid.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "two", "one")])  # at most BUCKETS * LEVELS ** 2, a fixed bound
    weights = learn_weights(cells.toArrow().sort_by("cell"))

    def run(rows: pa.Table, totals: dict[int, np.ndarray], _: int) -> pa.Table:
        _, _, doc, cw, cv, cvw = _counts(rows, totals)
        a = weights[_bucket(cv)]
        p = a[:, 0] * _safe(cvw, cv) + a[:, 1] * (cw / n if n else 0) + a[:, 2] / (v + 1)
        base = (cw + 0.5) / (n + 0.5 * (v + 1))
        size = len(rows)
        add = lambda x: pa.array(np.bincount(doc, weights=x, minlength=size), pa.float64())
        new = [pa.array(np.bincount(doc, minlength=size), pa.int64()),
               pa.array(np.bincount(doc, weights=cw > 0, minlength=size).astype(np.int64), pa.int64()),
               pa.array(np.full(size, n), pa.int64()), add(np.log10(base)), add(np.log10(p if n else np.ones(len(p))))]
        return pa.table([*[rows[c] for c in id_columns], *new], names=[*id_columns, *SCORED.names])

    schema = T.StructType([docs.schema[c] for c in id_columns] + SCORED.fields)
    return B.answered(packed, answers, run, schema)
