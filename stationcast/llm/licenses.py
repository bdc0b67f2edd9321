"""Licence scans: exact licence phrases, and fuzzy search for short licence notices.

Phrases: places where a phrase's words stand one after the other, words being runs of ASCII letters and digits and of non-ASCII
bytes, A-Z lower-cased.

Notices: a notice of ``m`` bytes is found with up to ``k`` errors (insertions, deletions and substitutions; ``error_rate`` times
``m``). Split into ``k + 1`` pieces, at least one piece stands in the text unchanged (pigeonhole), so an Aho-Corasick automaton over
all pieces of all notices finds every candidate diagonal (text position minus notice position); a match through that piece strays at most
``k`` diagonals from it. There a banded alignment, in time that grows with ``m`` times ``k``, narrows the window to one span and bounds
its errors; the regex library then matches the whole notice in that span within the bound and counts the edits, which stays short because the
window is no longer than the match (searching the wider window with ``BESTMATCH`` takes 140 ms at 9 errors, the span 1.2 ms).

What identifies a licence, its name and version, stands in brackets in a notice and must stand in the match unchanged, in order and as whole
words: the error budget is for the wording only, so one licence's notice is never another's with a few errors, nor version 1.1 version 2.0.

Texts are compared as UTF-8 bytes with A-Z lower-cased and each run of white space as one space; at a line
break, the comment marks that begin the next line belong to the run. Spans are byte offsets in the text as it came.

Defined cases: a NULL or empty text has no words and no places (score 0, empty labels); overlapping places all count; of overlapping
matches of one notice the one with the fewest errors stays, then the first; a repeated row is scanned again; an empty
table gives no row.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_python_columns
from .decontaminate import align
from .text_arrays import Docs, chunks, lowered, word_hashes, words

ERROR_RATE = 0.08
# Phrases and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# Wording of short notices, by licence label; what must stand unchanged is in brackets.
NOTICES = [
    ("afl-3.0", "licensed under the [academic free license] version [3.0]"),
    ("agpl", "under the terms of the [gnu affero general public license]"),
    ("apache-1.1", "the [apache] software license, version [1.1]"),
    ("apache-2.0", "licensed under the [apache] license, version [2.0]"),
    ("artistic-2.0", "under the terms of the [artistic license 2.0]"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsl-1.0", "distributed under the [boost] software license, version [1.0]"),
    ("cc-by-3.0", "this work is licensed under a creative commons [attribution 3.0] unported license"),
    ("cc-by-4.0", "this work is licensed under a creative commons [attribution 4.0] international license"),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons [attribution-noncommercial 4.0] international license"),
    ("cc-by-nc-nd-4.0", "this work is licensed under a creative commons [attribution-noncommercial-noderivatives 4.0] international license"),
    ("cc-by-nc-sa-4.0", "this work is licensed under a creative commons [attribution-noncommercial-sharealike 4.0] international license"),
    ("cc-by-nd-4.0", "this work is licensed under a creative commons [attribution-noderivatives 4.0] international license"),
    ("cc-by-sa-3.0", "this work is licensed under a creative commons [attribution-sharealike 3.0] unported license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons [attribution-sharealike 4.0] international license"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work"),
    ("cddl-1.0", "subject to the terms of the [common development and distribution license]"),
    ("ecl-2.0", "licensed under the [educational community] license, version [2.0]"),
    ("epl-1.0", "made available under the terms of the [eclipse] public license [v1.0]"),
    ("epl-2.0", "made available under the terms of the [eclipse] public license [2.0]"),
    ("eupl-1.2", "licensed under the [eupl], version [1.2]"),
    ("gpl", "free software: you can redistribute it and/or modify it under the terms of the [gnu general public license]"),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the [gnu lesser general public license]"),
    ("lgpl", "under the terms of the [gnu library general public license]"),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "licensed under the [mit] license"),
    ("mit", "released under the [mit] license"),
    ("mpl-1.1", "subject to the [mozilla] public license version [1.1]"),
    ("mpl-2.0", "this source code form is subject to the terms of the [mozilla] public license, v. [2.0]"),
    ("ms-pl", "subject to the [microsoft public license]"),
    ("ncsa", "[university of illinois/ncsa] open source license"),
    ("ofl-1.1", "this font software is licensed under the [sil open font license], version [1.1]"),
    ("psf", "licensed under the [python software foundation] license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided 'as-is', without any express or implied warranty"),
]
_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[9:14] = 32
# White space that is more than one byte or breaks a line, with the comment marks after each break.
_RUN = re.compile(rb"(?:[\t\v\f ]*[\r\n]+[\t\v\f ]*(?:/[/*]+!?|\*+/?|#+|;+|--+|%+|!+|>+|<!--)?)+[\t\v\f ]*|[\t-\r ]{2,}")


def wording(notice: str) -> tuple[str, list[str]]:
    """A notice without its brackets, and what stood in them."""
    return re.sub(r"[\[\]]", "", notice), re.findall(r"\[([^\]]+)\]", notice)


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length, with their offsets."""
    cut = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def collapsed(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``data`` with one space for each run, the documents' offsets in it, and the place that each of its bytes had."""
    out, stays, raw = _SPACED[data], np.ones(len(data), bool), data.tobytes()
    for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        for run in _RUN.finditer(raw, lo, hi):
            out[run.start()] = 32
            stays[run.start() + 1:run.end()] = False
    origin = np.flatnonzero(stays)
    return out[origin], np.searchsorted(origin, off), origin


class Notice(NamedTuple):
    label: str
    size: int
    budget: int
    data: np.ndarray
    text: str           # Latin-1: one character per byte
    fixed: list[bytes]  # what has to stand in a match unchanged, in this order

    def match(self, text: np.ndarray, place: int) -> tuple[int, int, int] | None:
        """``(errors, start, end)`` of the best match near the diagonal ``place`` of a document's bytes, if it keeps the budget."""
        lo = max(0, place - self.budget)
        window = text[lo:place + self.size + self.budget]
        if self.fixed:
            raw = window.tobytes()
            if not all(x in raw for x in self.fixed):
                return None
        got = align(self.data, window, place - lo, place - lo, self.budget)
        if not got:
            return None
        start, end = lo + got[0], lo + got[1]
        found = _within(self.text, got[2]).fullmatch(text[start:end].tobytes().decode("latin-1"))
        if not found or (self.fixed and not _whole(tuple(self.fixed)).search(text[max(0, start - 1):end + 2].tobytes())):
            return None
        return sum(found.fuzzy_counts), start, end


@lru_cache(maxsize=4096)
def _within(notice: str, errors: int) -> regex.Pattern:
    """The regex library's pattern for a notice with at most so many errors."""
    return regex.compile(f"(?:{regex.escape(notice, special_only=True, literal_spaces=True)}){{e<={errors}}}", regex.V1 | regex.DOTALL)


@lru_cache(maxsize=4096)
def _whole(fixed: tuple[bytes, ...]) -> re.Pattern:
    """Finds the given strings in order, each as whole words; a version that goes on (2.0.1) is another one."""
    return re.compile(b".*?".join(rb"(?<![0-9a-z\x80-\xff])" + re.escape(x) + rb"(?![0-9a-z\x80-\xff]|[.-][0-9a-z])" for x in fixed), re.DOTALL)


class Scanner:
    """Phrases and notices, prepared for searching. Texts are Latin-1 strings inside: one character per byte."""

    def __init__(self, phrases: list[tuple[str, str]], notices: list[tuple[str, str]], error_rate: float):
        self.phrases = []
        for phrase, label in phrases:
            data = np.frombuffer(phrase.encode(), np.uint8)
            self.phrases.append((word_hashes(data, words(data, np.array([0, len(data)]), _BREAK)), label))
        self.notices, seeds = [], {}
        for label, notice in notices:
            text, fixed = wording(notice)
            wide = text.encode().decode("latin-1")
            k = int(error_rate * len(wide))
            at = len(self.notices)
            self.notices.append(Notice(label, len(wide), k, np.frombuffer(text.encode(), np.uint8), wide, [x.encode() for x in fixed]))
            for offset, piece in pieces(wide, k):
                seeds.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        if seeds:
            self.automaton.make_automaton()

    def exact(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, str]]]:
        """Words per document, and for each phrase the words where it starts (numbered through the chunk)."""
        w = words(data, off, _BREAK)
        h = word_hashes(data, w)
        doc = np.repeat(np.arange(len(off) - 1), np.diff(w.off))
        found = []
        for phrase, label in self.phrases:
            n = len(h) - len(phrase) + 1
            at = np.flatnonzero(h[:max(0, n)] == phrase[0])
            for k, x in enumerate(phrase[1:], 1):
                at = at[h[at + k] == x]
            found.append((at[doc[at] == doc[at + len(phrase) - 1]] if len(at) else at, label))
        return w.off, found

    def fuzzy(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """``(document, notice, start, end, errors)`` of a chunk, offsets within the document."""
        if not self.notices:
            return []
        diagonals: dict[tuple[int, int], set[int]] = {}
        for end, (size, places) in self.automaton.iter(data.tobytes().decode("latin-1")):
            d = int(np.searchsorted(off, end, "right")) - 1
            start = end - size + 1 - int(off[d])
            if start >= 0:
                for at, offset in places:
                    diagonals.setdefault((d, at), set()).add(start - offset)
        out = []
        for (d, at), places in diagonals.items():
            notice = self.notices[at]
            taken: set[tuple[int, int, int]] = set()
            text = data[off[d]:off[d + 1]]
            for place in places:
                got = notice.match(text, place)
                if got:
                    taken.add(got)
            kept: list[tuple[int, int, int]] = []
            for errors, start, end in sorted(taken):
                if all(end <= a or start >= b for _, a, b in kept):
                    kept.append((errors, start, end))
            out += [(d, at, start, end, errors) for errors, start, end in kept]
        return out

    def scan(self, docs: Docs) -> list[dict]:
        data = lowered(docs.data)
        off, found = self.exact(data, docs.off)
        n = np.diff(off)
        starts: list[list[int]] = [[] for _ in n]
        base: list[set[str]] = [set() for _ in n]
        for at, label in found:
            doc = np.searchsorted(off, at, "right") - 1
            for d, place in zip(doc.tolist(), (at - off[doc]).tolist(), strict=True):
                starts[d].append(place)
                base[d].add(label)
        spans: list[list[dict]] = [[] for _ in n]
        best = [1.0 if s else 0.0 for s in starts]
        plain, plain_off, origin = collapsed(data, docs.off)
        for d, at, start, end, errors in self.fuzzy(plain, plain_off):
            label, m = self.notices[at][:2]
            first, last = origin[plain_off[d] + np.array([start, end - 1])] - docs.off[d]
            spans[d].append({"label": label, "start": int(first), "end": int(last) + 1, "errors": errors})
            best[d] = max(best[d], 1 - errors / m)
        out = []
        for d, count in enumerate(n.tolist()):
            spans[d].sort(key=lambda s: (s["start"], s["end"], s["label"]))
            out.append({"n_words": count, "n_base": len(starts[d]), "first_word": min(starts[d], default=None),
                        "last_word": max(starts[d], default=None), "base_labels": ",".join(sorted(base[d])),
                        "labels": ",".join(sorted(base[d] | {s["label"] for s in spans[d]})), "score": best[d], "spans": spans[d]})
        return out


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, notices: tuple, error_rate: float) -> Scanner:
    return Scanner(list(phrases), list(notices), error_rate)


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("errors", pa.int32())])
_ARROW = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))]
_SPAN_TYPE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()),
                          T.StructField("end", T.IntegerType()), T.StructField("errors", T.IntegerType())])
_FIELDS = [*[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")],
           T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
           T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(_SPAN_TYPE))]


def scan(docs: DataFrame, text: str = "text", phrases: list[tuple[str, str]] = PHRASES,
         notices: list[tuple[str, str]] = NOTICES, error_rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` with ``n_words, n_base, first_word, last_word, base_labels, labels, score, spans``; no shuffle."""
    wanted = tuple(map(tuple, phrases)), tuple(map(tuple, notices))

    def make(column):
        rows = [r for c in chunks(column) for r in _scanner(*wanted, error_rate).scan(c)]
        return [pa.array([r[n] for r in rows], t) for n, t in _ARROW]

    return with_python_columns(docs, text, _FIELDS, make)
