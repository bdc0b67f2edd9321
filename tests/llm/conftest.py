from __future__ import annotations

import random
import shutil
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

VOCABULARY = ["the", "of", "and", "to", "stone", "river", "Cloud", "paper,", "yellow.", "größer", "été", "日本", "7", "walk", "idea",
              "morning", "window", "quiet", "table", "simple"]
TOXIC = ["idiot", "scum", "moron"]
PASSAGE = "A benchmark passage about seventeen copper kettles that nobody in the harbour town wanted to polish before noon."
LICENSE = "Licensed under the Apache License, Version 2.0 (the License)"


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(VOCABULARY) + (str(rng.randrange(40)) if rng.random() < 0.3 else "") for _ in range(n)]
    return "".join(w + (rng.choice(["\n", "  ", "\t"]) if rng.random() < 0.05 else " ") for w in words).rstrip(" ")


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(1000))
    return " ".join(words)


def corpus() -> list[dict]:
    """Small documents with every awkward case: nulls, empties, copies, near copies, shared passages, a very long text."""
    rng = random.Random(5)
    texts: list[str | None] = [None, "", "   \n\t ", "one", "four words are here", "a\nb\na\nb\n\n", "?!.", "x" * 5000, "ab" * 700, " lead and trail "]
    base = prose(rng, 120)
    shared = prose(rng, 60)
    texts += [base, base, base.upper(), edited(rng, base, 1), edited(rng, base, 2), edited(rng, base, 9)]
    texts += [prose(rng, rng.randrange(5, 160)) for _ in range(25)]
    texts += [prose(rng, 30) + " " + shared + " " + prose(rng, 20) for _ in range(6)]
    texts += [prose(rng, 40) + " " + PASSAGE + " " + prose(rng, 10), prose(rng, 15) + PASSAGE.replace("copper", "cooper").upper()]
    texts += [prose(rng, 30) + " " + LICENSE, "the MIT License and GNU General-Public License; cc BY", LICENSE.replace("Version", "Versoin")]
    texts += [" ".join(["again and again we repeat these very eight words"] * 20), prose(rng, 20_000)]
    texts += ["*** $$$ ### " * 60, "SE!! OH!! NO!! " * 40]
    for i in range(60):
        texts.append(prose(rng, 40) + ((" " + rng.choice(TOXIC) + " " + prose(rng, 5)) if i % 3 == 0 else ""))
    rows = [{"doc_id": 3 * i + 1, "text": t, "lang": ["en", "de", None][i % 3], "source": f"s{i % 4}", "n_chars": len(t or "")}
            for i, t in enumerate(texts)]
    rows.append(dict(rows[12]))                                              # a repeated row
    rows.append({"doc_id": None, "text": "no id " + prose(rng, 30), "lang": None, "source": None, "n_chars": None})
    rng.shuffle(rows)
    return rows


SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
CLASH = ["n_words", "kept", "matches", "score", "features", "base_failed", "cid", "held_out", "n_tokens", "ref_lang", "x0"]


def write_tables(folder: str, docs: list[dict]) -> str:
    table = pa.Table.from_pylist(docs, SCHEMA)
    for name in CLASH:
        table = table.append_column(name, pa.array(["own"] * len(docs), pa.string()))
    pq.write_table(table, f"{folder}/documents.parquet")
    some = bool(docs)
    toxic = [{"doc_id": d["doc_id"], "toxic": int(any(w in (d["text"] or "") for w in TOXIC)), "quality": None} for d in docs]
    toxic += [{"doc_id": None, "toxic": 1, "quality": 1}, {"doc_id": 4, "toxic": None, "quality": 0}] * some
    pq.write_table(pa.Table.from_pylist(toxic, pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])),
                   f"{folder}/labels.parquet")
    bench = [{"item_id": 1, "text": PASSAGE}, {"item_id": 2, "text": None}, {"item_id": 3, "text": "short"}, {"item_id": 4, "text": PASSAGE}]
    pq.write_table(pa.Table.from_pylist(bench * some, pa.schema([("item_id", pa.int64()), ("text", pa.string())])), f"{folder}/benchmark.parquet")
    pages = [{"page_id": i, "url": None if i % 7 == 0 else f"http://h/{i}\n", "html": [None, "", "<p>é</p>\r\n\r\nWARC/1.1", "<b>x</b>" * i][i % 4]}
             for i in range(40)] + [{"page_id": 39, "url": "u", "html": "<b>x</b>" * 39}, {"page_id": None, "url": "u", "html": "alone"}]
    pq.write_table(pa.Table.from_pylist(pages * some, pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])),
                   f"{folder}/pages.parquet")
    vectors, talks = (vector_rows(), talk_rows()) if some else ([], [])
    clash = lambda t, names: [t := t.append_column(n, pa.array(["own"] * t.num_rows, pa.string())) for n in names][-1]
    pq.write_table(clash(pa.Table.from_pylist(vectors, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])),
                         ["row", "q", "norm", "a", "r", "rank"]), f"{folder}/embeddings.parquet")
    pq.write_table(clash(pa.Table.from_pylist(talks, pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])),
                         ["first", "path", "key", "kind", "depth"]), f"{folder}/conversations.parquet")
    return folder


def vector_rows() -> list[dict]:
    """Vectors with ties, copies of rows and vectors, rows that take no part, a hot label and anchors among all of these."""
    rng = random.Random(11)
    rows = [{"vec_id": i, "embedding": [rng.choice([-0.5, 0.0, 0.25, 0.5, rng.random()]) for _ in range(8)], "label": 3 if i % 3 == 0 else i % 5}
            for i in range(230)]
    for i in range(40):
        rows.append({"vec_id": 300 + 10 * i, "embedding": rows[50]["embedding"], "label": i % 4})
    rows += [dict(rows[100]), dict(rows[100]), dict(rows[101]), {"vec_id": 7, "embedding": rows[3]["embedding"], "label": 1}]
    rows += [{"vec_id": 50, "embedding": None, "label": 1}, {"vec_id": 1000, "embedding": [1.0] * 8, "label": None},
             {"vec_id": None, "embedding": [1.0] * 8, "label": 1}, {"vec_id": 1050, "embedding": [None] + [1.0] * 7, "label": 1},
             {"vec_id": 1100, "embedding": [float("nan")] + [1.0] * 7, "label": 1}, {"vec_id": 1150, "embedding": [float("inf")] + [1.0] * 7, "label": 1},
             {"vec_id": 1200, "embedding": [0.0] * 8, "label": 2}, {"vec_id": 1250, "embedding": [0.9] * 8, "label": 77}]
    rng.shuffle(rows)
    return rows


def talk_rows() -> list[dict]:
    """Conversations with a common first turn, whole copies, NULLs, ties, repeated rows, a missing base and a long one."""
    rng = random.Random(13)
    rows = []
    for c in range(90):
        if c in (15, 16, 40):
            continue
        for t in range(rng.randrange(0, 9)):
            text = "hello there" if t == 0 and c % 3 else rng.choice(["yes", "no", "été 日本", "", None, f"only {c}"])
            rows.append({"conv_id": c, "turn": None if rng.random() < 0.05 else t, "role": rng.choice(["user", "assistant", None, ""]), "text": text})
    for c in range(200, 240):
        rows += [{"conv_id": c, "turn": t, "role": "user", "text": f"the same {t}"} for t in range(4)]
    rows += [{"conv_id": 300, "turn": t, "role": "user", "text": f"long {t % 7}"} for t in range(400)]
    rows += [dict(rows[3]), dict(rows[3]), {"conv_id": None, "turn": 1, "role": "user", "text": "nobody"}, {"conv_id": -8, "turn": 0, "role": "user", "text": "minus"}]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs() -> list[dict]:
    return corpus()


@pytest.fixture(scope="session")
def tables(docs):
    folder = tempfile.mkdtemp(prefix="llm-tables-")
    yield write_tables(folder, docs)
    shutil.rmtree(folder)


@pytest.fixture(scope="session")
def empty_tables():
    folder = tempfile.mkdtemp(prefix="llm-empty-")
    yield write_tables(folder, [])
    shutil.rmtree(folder)
