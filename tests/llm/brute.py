"""Plain versions of the operators, for small data."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


def shingle_set(text: str | None) -> frozenset:
    w = lower(text).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_groups(docs: list[dict], percent: int = 85) -> dict[int, int]:
    sets = [(d["doc_id"], shingle_set(d["text"])) for d in docs if d["doc_id"] is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    w = SPACE_WORD.findall(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def quality_kept(docs: list[dict]) -> list[bool]:
    """The verdicts of the quality rules: mean histograms by language, Jensen-Shannon distances to them."""
    import unicodedata

    from stationcast.llm import quality as Q

    def kind(c: str) -> str:
        k = unicodedata.category(c)
        return ("lower" if k[0] == "L" and k != "Lu" else "upper" if k == "Lu" else "digit" if k[0] == "N" else "space" if c in " \t\n\r\f\v"
                else "symbol" if c in "#*$%&|<>" else "punctuation" if c in ".,;:!?'\"()-" else "other")

    def share(counts: list[int], n: int) -> list[int]:
        return [c * 10**6 // n if n else 0 for c in counts]

    hist = []
    for d in docs:
        text = d["text"] or ""
        w = SPACE_WORD.findall(text)
        common = [sum(x.lower() == c for x in w) for c in Q.COMMON_WORDS]
        classes = Counter(map(kind, text))
        hist.append((share([classes[c] for c in Q.CLASSES], len(text)), share([*common, len(w) - sum(common)], len(w)), len(text), len(w)))
    mean = {}
    for lang in {d["lang"] for d in docs}:
        own = [h for d, h in zip(docs, hist, strict=True) if d["lang"] == lang and h[3]]
        mean[lang] = [[sum(h[i][k] for h in own) / (len(own) * 10**6) for k in range(len(hist[0][i]))] for i in (0, 1)]

    def distance(p: list[int], q: list[float]) -> float:
        total = 0.0
        for a, b in zip([x / 10**6 for x in p], q, strict=True):
            total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x > 0)
        return round(math.sqrt(max(0.0, total / 2)), 6)

    out = []
    for d, (c, w, chars, words) in zip(docs, hist, strict=True):
        ref = mean[d["lang"]]
        far = (chars >= Q.CLASS_MIN_CHARS and distance(c, ref[0]) > Q.CLASS_LIMIT) or (
            words >= Q.WORD_MIN_WORDS and distance(w, ref[1]) > Q.WORD_LIMIT)
        out.append(not quality_counts(d["text"])[5] and not far)
    return out


def without_repeats(texts: list[str | None], size: int = 200) -> list[tuple[int, int, int, bytes]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + size] for x in data for i in range(len(x) - size + 1))
    out = []
    for x in data:
        gone, end = bytearray(len(x)), 0
        for i in range(len(x) - size + 1):
            if seen[x[i:i + size]] > 1:
                for k in range(max(i, end), i + size):
                    gone[k] = 1
                end = i + size
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


def edit_match(passage: bytes, text: bytes) -> int:
    """The fewest edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage):
        last, row[0] = row[0], i + 1
        for j, t in enumerate(text):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (p != t))
    return min(row)


def fold(text: str | None) -> bytes:
    text = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" else c for c in text or "")
    return re.sub(rb"[\x09-\x0D]", b" ", text.encode())


def license_base(text: str | None) -> tuple:
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    starts, labels = [], set()
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.encode().split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def crc(doc_id: int | None, n: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def base_scores(docs: list[dict]) -> list[tuple]:
    tokens = [lower(d["text"]).split() + [None] for d in docs]
    held = [crc(d["doc_id"], 5) == 1 for d in docs]
    c = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    return [(h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts))
            for ts, h in zip(tokens, held, strict=True)]


def base32_sha1(text: str | None) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()
