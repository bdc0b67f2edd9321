"""Fuzzy notices at the whole error rate, and through line breaks and comment marks."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import pyarrow as pa

from stationcast.llm import licenses as L
from stationcast.llm.text_arrays import chunks

from . import brute


def scanned(texts):
    scanner = L._scanner(tuple(L.PHRASES), tuple(L.NOTICES), L.ERROR_RATE)
    return [r for c in chunks(pa.array(texts)) for r in scanner.scan(c)]


def test_notice_wrapped_in_a_comment():
    isc = next(t for label, t in L.NOTICES if label == "isc")
    w = isc.split(" ")
    for mark in (" * ", "# ", "// ", ";; ", "-- ", "  ", " *\n * "):
        text = "/*\n" + mark + "é " + ("\n" + mark).join([" ".join(w[:6]), " ".join(w[6:11]), " ".join(w[11:17]), " ".join(w[17:])]) + ".\n*/"
        (r,) = scanned([text])
        (s,) = r["spans"]
        raw = text.encode()[s["start"]:s["end"]].decode()
        assert (s["label"], s["errors"], r["score"]) == ("isc", 0, 1.0)
        assert raw.startswith("permission to use") and raw.endswith("hereby granted")


def test_runs_stay_inside_their_document():
    cut = "released under the  mit license  "
    assert [[(s["start"], s["end"]) for s in r["spans"]] for r in scanned(["x \n", "  " + cut, None, "\n * " + cut, ""])] == [
        [], [(2, 33)], [], [(4, 35)], []]


def editable(notice):
    """The wording, and the places in it where an edit leaves what is in brackets and the places next to it alone."""
    text, free = "", []
    for part in re.split(r"(\[[^\]]*\])", notice):
        if part.startswith("["):
            text += part[1:-1]
        else:
            free += range(len(text) + 2, len(text) + len(part) - 2)
            text += part
    return text, free


def test_every_notice_up_to_its_error_rate():
    rng = random.Random(11)
    texts, wants = [], []
    for label, notice in L.NOTICES:
        notice, free = editable(notice)
        k = int(L.ERROR_RATE * len(notice))
        for n in [k, k, k + 1]:
            # the edits are spread out and never make the notice's own letters, so that all of them are needed
            x = list(notice)
            for i in rng.sample(free[::2], n):
                x[i] = rng.choice(["", "~", "~" + x[i]]) if x[i] != " " else x[i] + "~"
            found = "".join(x)
            text = "abc def " + found + " ghi jkl"
            texts.append(text)
            wants.append((label, brute.edit_match(notice.encode(), re.sub(" +", " ", text).encode()), k))
    for r, text, (label, errors, k) in zip(scanned(texts), texts, wants, strict=True):
        got = [s["errors"] for s in r["spans"] if s["label"] == label]
        assert (min(got, default=None) == errors) if errors <= k else not got, (label, text)
    assert max(e for _, e, _ in wants) > 8


def test_spans_hold_the_errors_they_name():
    rng = random.Random(12)
    texts = []
    for _ in range(150):
        x = list(L.wording(rng.choice(L.NOTICES)[1])[0])
        for i in rng.sample(range(len(x)), rng.randrange(0, 9)):
            x[i] = rng.choice("abc ")
        texts.append("été " * rng.randrange(5) + "".join(x) + " and more")
    found = 0
    for r, text in zip(scanned(texts), texts, strict=True):
        for s in r["spans"]:
            part = brute.fold(text)[s["start"]:s["end"]]
            plain, _, _ = L.collapsed(np.frombuffer(part, np.uint8), np.array([0, len(part)]))
            assert any(label == s["label"] and brute.edit_match(L.wording(n)[0].encode(), plain.tobytes()) == s["errors"] for label, n in L.NOTICES)
            found += 1
    assert found > 30


@pytest.mark.parametrize("text, label", [
    ("Released under the MPL license", ""), ("Released under the MIT license", "mit"), ("Relaesed under the MIT license", "mit"),
    ("Released under the MITx license", ""), ("Licensed under the Apache License, Version 1.1", "apache"),
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"), ("Licenced under the Apache License Version 2.0.", "apache,apache-2.0"),
    ("Licensed under the Apache License, Version 2.0.1", "apache"), ("Licensed under the Apache License, Version 12.0", "apache"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1", ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License", ""),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", "cc-by-3.0"),
    ("This work is licensed under a Creative Commons Attribution-NC 4.0 International License", ""),
    ("This work is licensed under the Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
    ("under the terms of the GNU Lesser General Public License as", "lgpl"), ("under the terms of the GNU Affero General Public License", "agpl"),
    ("This is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("This is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lgpl"),
])
def test_names_and_versions_are_exact(text, label):
    (r,) = scanned([text])
    assert r["labels"] == label


def test_exact_notices_have_their_own_label_only():
    for (label, notice), r in zip(L.NOTICES, scanned([L.wording(n)[0] for _, n in L.NOTICES]), strict=True):
        text = L.wording(notice)[0]
        assert {s["label"] for s in r["spans"]} == {label} and r["score"] == 1.0, notice
        assert (0, len(text), 0) in [(s["start"], s["end"], s["errors"]) for s in r["spans"]]


def test_all_matches_against_every_place():
    """Labels of edited notices, edits anywhere, against the plain edit distance of every notice and its exact parts."""
    rng, texts = random.Random(5), []
    for _, notice in L.NOTICES * 2:
        x = list(L.wording(notice)[0])
        for i in rng.sample(range(len(x)), rng.randrange(0, int(L.ERROR_RATE * len(x)) + 1)):
            x[i] = rng.choice(["", "~", x[i] + "~", x[i]])
        texts.append("abc " + "".join(x) + " ghi")
    for text, r in zip(texts, scanned(texts), strict=True):
        want = set()
        for label, notice in L.NOTICES:
            words, fixed = L.wording(notice)
            whole = all(re.search(rf"(?<![0-9a-z]){re.escape(x)}(?![0-9a-z]|[.-][0-9a-z])", text) for x in fixed)
            if whole and brute.edit_match(words.encode(), re.sub(" +", " ", text).encode()) <= int(L.ERROR_RATE * len(words)):
                want.add(label)
        assert {s["label"] for s in r["spans"]} == want, text
