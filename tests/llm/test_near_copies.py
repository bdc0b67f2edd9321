"""Near-duplicates with many copies of each row: work and answers must not grow with powers of the number of copies."""

from __future__ import annotations

from stationcast.llm import near_duplicates as N

from . import brute


def rows(copies: int) -> list[dict]:
    base = [f"w{j}" for j in range(104)]
    near, far = [*base[:-3], "x", "y", "z"], [f"v{j}" for j in range(60)]
    docs = [{"doc_id": i, "text": " ".join(t)} for i, t in ((7, base), (3, near), (9, far))]
    return docs * copies + [{"doc_id": 100 + i, "text": " ".join(near)} for i in range(copies)]


def test_repeated_rows_answer_as_the_brute_force(spark):
    docs = rows(12)
    table = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string")
    want = brute.near_groups([d for i, d in enumerate(docs) if d not in docs[:i]])
    got = N.groups(table).collect()
    assert len(got) == len(docs) and all(r["component_id"] == want[r["doc_id"]] for r in got)


def test_each_copy_is_verified_once(spark):
    docs = rows(200)
    table = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string").repartition(4)
    ids = spark.createDataFrame([(7,), (3,)], "cid long")
    assert N._sets(table, ids, 5).count() == 2
    got = {r["doc_id"]: r["component_id"] for r in N.groups(table).collect()}
    assert got[7] == got[3] == got[250] == 3 and got[9] == 9


def test_one_id_with_different_texts_keeps_each_set(spark):
    a, b = " ".join(f"w{j}" for j in range(40)), " ".join(f"v{j}" for j in range(40))
    table = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (1, a)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in N.groups(table).collect()} == {1: 1, 2: 1, 3: 1}
