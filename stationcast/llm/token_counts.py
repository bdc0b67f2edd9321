"""Token counts under a unigram vocabulary, without making the tokens.

The vocabulary is the pieces and scores of a SentencePiece file, read as a unigram model: a text is cut so that the sum
of its pieces' scores is largest. An Aho-Corasick automaton enumerates the pieces that end at each character, the longest
first, and a Viterbi pass carries the best score and the number of pieces to each end. Ties follow the tokenizer: an equal
score does not replace one found before, so the piece that starts earliest stays; a character that is no piece is an
unknown one at the least score minus 10, and counts its UTF-8 bytes where the vocabulary has byte pieces; scores are added
in single precision.

Spaces become U+2581 and one is put in front, as the tokenizer does. In such vocabularies no piece goes on after a
non-space character with a space (checked when the file is read), so the text falls into independent stretches (a run of spaces
and the word after it). Each distinct stretch of a batch is solved once; the counts of a document's stretches are added up. The
scores of a stretch start at 0, so a long text loses no precision.

Scores are floored at ``FLOOR``: the file marks pieces that merging never makes with -1e9, beside which single precision
loses all other differences.

The file's path is a parameter; each task reads it by itself, so it must be present on every node.

Defined cases: a NULL or empty text has 0 tokens; spaces alone are a stretch; a repeated row is counted again; an empty table
gives no row.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_python_columns
from .text_arrays import GOLDEN, U, Docs, chunks, mix, word_hashes, words

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
FLOOR = -40_000.0
KNOWN = 300_000
EXACT = float(1 << 24)  # whole scores up to here are exact in single precision
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True


class Vocabulary(NamedTuple):
    automaton: ahocorasick.Automaton
    unknown: float
    has_bytes: bool


def build(pieces: dict[str, float], has_bytes: bool) -> Vocabulary:
    """From the pieces and their scores; single characters are marked, as they rule out the unknown one."""
    a = ahocorasick.Automaton()
    for piece, score in pieces.items():
        if SPACE in piece.lstrip(SPACE):
            raise ValueError(f"the piece {piece!r} goes past the start of a word")
        a.add_word(piece, (len(piece), float(np.float32(score))))
    a.make_automaton()
    return Vocabulary(a, float(np.float32(min(pieces.values(), default=0.0) - UNKNOWN_PENALTY)), has_bytes)


@cache
def load(path: str, floor: float = FLOOR) -> Vocabulary:
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(m.get_piece_size())
    plain = {m.id_to_piece(i): max(m.get_score(i), floor) for i in n
             if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
    return build(plain, any(m.is_byte(i) for i in n))


def count(v: Vocabulary, stretch: str) -> int:
    """The number of pieces on the best path through ``stretch`` (spaces already replaced)."""
    n = len(stretch)
    score, pieces = [0.0] * (n + 1), [0] * (n + 1)
    done = 0  # ends up to here are settled

    def unknown(end: int, best: float | None, k: int) -> None:
        s = score[end - 1] + v.unknown
        if s < -EXACT:
            s = float(np.float32(s))
        if best is None or s > best:
            best, k = s, pieces[end - 1] + (len(stretch[end - 1].encode()) if v.has_bytes else 1)
        score[end], pieces[end] = best, k

    best, k, single, at = None, 0, False, 0
    for last, (length, s) in v.automaton.iter(stretch):
        end = last + 1
        if end != at:
            if at:
                if single:
                    score[at], pieces[at] = best, k
                else:
                    unknown(at, best, k)
                done = at
            for e in range(done + 1, end):
                unknown(e, None, 0)
            best, k, single, at = None, 0, False, end
        s += score[end - length]
        if s < -EXACT:
            s = float(np.float32(s))
        if best is None or s > best:
            best, k = s, pieces[end - length] + 1
        single = single or length == 1
    if at:
        if single:
            score[at], pieces[at] = best, k
        else:
            unknown(at, best, k)
        done = at
    for e in range(done + 1, n + 1):
        unknown(e, None, 0)
    return pieces[n]


class Counter:
    """Counts of distinct stretches, known by a 64-bit hash; at most ``KNOWN`` are kept from batch to batch."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}

    def counts(self, docs: Docs) -> np.ndarray:
        w = words(docs.data, docs.off, _BLANK)
        n = np.diff(w.off)
        size = np.diff(docs.off)
        doc = np.repeat(np.arange(len(n)), n)
        before = np.zeros(len(doc), np.int64)
        before[1:] = w.end[:-1]
        first = w.off[:-1][n > 0]
        before[first] = docs.off[:-1][n > 0]
        run = w.start - before
        run[first] += 1                       # the space in front of the text
        tail = docs.off[1:].copy()            # spaces after the last word
        tail[n > 0] -= w.end[w.off[1:][n > 0] - 1]
        tail[n == 0] = size[n == 0] + (size[n == 0] > 0)
        key = mix(word_hashes(docs.data, w) + run.astype(np.uint64) * GOLDEN)
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(key) else np.zeros(0, bool)
        value = np.zeros(int(new.sum()), np.int64)
        data = docs.data.tobytes()
        if len(self.known) > KNOWN:
            self.known = {}
        for i, (x, at) in enumerate(zip(ranked[new].tolist(), order[new].tolist(), strict=True)):
            c = self.known.get(x)
            if c is None:
                text = data[w.start[at]:w.end[at]].decode()
                c = self.known[x] = count(self.v, SPACE * int(run[at]) + text)
            value[i] = c
        of_word = np.empty(len(key), np.int64)
        of_word[order] = value[np.cumsum(new) - 1]
        total = np.bincount(doc, weights=of_word, minlength=len(n)).astype(np.int64)
        for d in np.flatnonzero(tail > 0).tolist():
            total[d] += count(self.v, SPACE * int(tail[d]))
        return total


def token_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with long column ``name``; no shuffle."""
    def make(column, state=[]):  # noqa: B006  one counter per Python worker and task
        if not state:
            state.append(Counter(load(path)))
        parts = [state[0].counts(c) for c in chunks(column)]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())]

    return with_python_columns(docs, text, [T.StructField(name, T.LongType())], make)
