"""Byte-level BPE by merge replay over a whole batch of words.

Texts are cut into words by the tokenizer's pattern; the distinct words of a batch are laid end to end as one array of
symbols. An inverted index holds, for each pair of neighbouring symbols that the vocabulary can merge, the positions where
it stands. Merges are then replayed in rank order over all words at once: a merge visits only the positions of its pair
and updates only their neighbours' pairs. Each text takes the ids of its words.

The result equals the greedy encoder that merges, in one word, the neighbours whose joined bytes have the lowest rank, the
leftmost first: words do not influence each other, and within a word a position is merged only while its rank is the word's
lowest. A merge whose product could make a still lower rank (``risky``) is replayed one position per word at a time. A word
that is a token itself is that token.

Ranks are read from a file in the tiktoken format; its path is a parameter and each task reads it by itself, so it must be
present on every node (it is part of an installed package here).

Defined cases: a NULL text is an empty text (no ids, and it decodes to no bytes); an id not in the vocabulary cannot be decoded
and raises; a repeated row is encoded again; an empty table gives no row. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_python_columns

KNOWN_WORDS = 200_000
BATCH_BYTES = 8 << 20


class Vocabulary:
    """Ranks of a tiktoken file, and the merges they imply: symbol pairs whose joined bytes are a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes = {i: t for t, i in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((ranks[t[:k]] * self.size + ranks[t[k:]], i) for t, i in ranks.items()
                       for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self.pair = np.array([p for p, _ in pairs], np.int64)
        self.rank = np.array([r for _, r in pairs], np.int64)
        low = np.full(self.size, self.size, np.int64)  # the lowest rank a symbol can go on to
        for side in (self.pair // self.size, self.pair % self.size):
            np.minimum.at(low, side, self.rank)
        self.risky = low < np.arange(self.size)

    def merge_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's joined bytes, -1 if they are no token."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], -1)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each (non-empty) word."""
        whole = [self.ranks.get(w) for w in words]
        split = [w for w, t in zip(words, whole, strict=True) if t is None]
        out = iter(self._replay(split) if split else [])
        return [[t] if t is not None else next(out) for t in whole]

    def _replay(self, words: list[bytes]) -> list[list[int]]:
        length = np.array([len(w) for w in words])
        symbol = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), length)
        n = len(symbol)
        start = np.cumsum(length) - length
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[start + length - 1] = -1
        before[start] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """The pairs that begin at these positions go into the index."""
            at = at[after[at] >= 0]
            rank = self.merge_rank(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if len(at):
                order = np.lexsort((at, rank))
                at, rank = at[order], rank[order]
                cut = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
                for r, part in zip(rank[cut].tolist(), np.split(at, cut[1:]), strict=True):
                    if r not in index:
                        index[r] = []
                        heapq.heappush(heap, r)
                    index[r].append(part)

        enter(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[alive[at] & (after[at] >= 0)]
            at = at[self.merge_rank(symbol[at], symbol[after[at]]) == r]
            if not len(at):
                continue
            later = at[:0]
            if self.risky[r]:
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                at, later = at[first], at[~first]
            elif len(at) > 1:
                # in a run of overlapping positions (each the next one's left symbol) every second one merges
                joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
                if joined.any():
                    head = np.maximum.accumulate(np.where(~joined, np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - head) % 2 == 0]
            gone = after[at]
            symbol[at] = r
            alive[gone] = False
            after[at] = after[gone]
            right = after[at][after[at] >= 0]
            before[right] = at[after[at] >= 0]
            left = before[at]
            enter(np.unique(np.concatenate([at, left[left >= 0], later])))
        ids = symbol[alive]
        cut = np.cumsum(np.bincount(word[alive], minlength=len(words)))[:-1]
        return [x.tolist() for x in np.split(ids, cut)]


@cache
def load(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


class Encoder:
    """Encodes batches; what is known of up to ``KNOWN_WORDS`` words is kept from batch to batch: the number of ids, the ids as
    decimals, the ids, and the bytes that they decode to."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}

    def words(self, texts: list[str]) -> list[list[str]]:
        out = list(map(self.vocabulary.pattern.findall, texts))
        here = set().union(*out)
        new = list(here - self.known.keys())
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {w: self.known[w] for w in here & self.known.keys()}
        for w, ids in zip(new, self.vocabulary.replay([w.encode() for w in new]), strict=True):
            self.known[w] = (len(ids), " ".join(map(str, ids)), ids, self.decode(ids))
        return out

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [[i for w in ws for i in self.known[w][2]] for ws in self.words(texts)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


def _batches(texts: list[str | None]):
    """Bounded groups of texts, in order; NULL is empty."""
    part, have = [], 0
    for t in texts:
        part.append(t or "")
        have += len(part[-1])
        if have >= BATCH_BYTES:
            yield part
            part, have = [], 0
    if part:
        yield part


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with array column ``name`` of token ids."""
    def make(column, state=[]):  # noqa: B006  one encoder per task
        if not state:
            state.append(Encoder(load(path, pattern)))
        return [pa.array([x for b in _batches(column.to_pylist()) for x in state[0].ids(b)], pa.list_(pa.int32()))]

    return with_python_columns(docs, text, [T.StructField(name, T.ArrayType(T.IntegerType()))], make)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with binary column ``name``: the bytes of the tokens in array column ``ids`` (NULL: no bytes)."""
    def make(column):
        v = load(path, pattern)
        return [pa.array([b"".join(map(v.bytes.__getitem__, x or [])) for x in column.to_pylist()], pa.binary())]

    return with_python_columns(docs, ids, [T.StructField(name, T.BinaryType())], make)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the decimal ids with a space between) and ``decoded_sha256`` (of the bytes that the
    ids decode to), in one pass; with ``ids``, also the array ``ids`` itself."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType()))][:4 if ids else 3]

    def make(column, state=[]):  # noqa: B006  one encoder per task: its words are freed with the task
        if not state:
            state.append(Encoder(load(path, pattern)))
        e, cols, flat = state[0], ([], [], []), []
        for batch in _batches(column.to_pylist()):
            for ws in e.words(batch):
                n, names, own, raw = zip(*map(e.known.__getitem__, ws), strict=True) if ws else ((), (), (), ())
                cols[0].append(sum(n))
                cols[1].append(hashlib.sha256(" ".join(names).encode()).hexdigest())
                cols[2].append(hashlib.sha256(b"".join(raw)).hexdigest())
                if ids:
                    flat.append(np.fromiter(itertools.chain.from_iterable(own), np.int32, cols[0][-1]))
        out = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
        if ids:
            ends = np.cumsum([0, *cols[0]])
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *flat]))))
        return out

    return with_python_columns(docs, text, fields, make)
