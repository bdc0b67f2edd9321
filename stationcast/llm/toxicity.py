"""Toxicity score: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are the presence of its 4- to 7-byte strings (UTF-8, A-Z lower-cased, white space read as a space, one space
before and after), hashed into ``SLOTS``. Training (after Wang and Manning 2012):

1. per slot the smoothed log ratio of its frequency among the labelled toxic and the other documents;
2. slots whose ratio stands out from chance by ``LEAST_Z`` go on;
3. a logistic regression on the presence of those slots, each with its ratio as the value.

Learning takes ``limit`` labelled documents at most (a documented bound on labelled rows, chosen by the hash of their ids, so the
choice does not depend on file order); the ratio counts and the regression see exactly those. Scoring covers every document and all
of its text. Nothing but the text enters a score.

Defined cases: a NULL or empty text has only its spaces and still gets a score; a NULL label or id is not learned from; without both
classes among the labels, or without a slot that stands out, every score is the smoothed share of toxic labels; a
repeated row is scored again; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_python_columns, written
from .text_arrays import GOLDEN, U, Docs, chunks, distinct

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
GRAMS = (4, 5, 6, 7)
LIMIT = 12_000
PER_TASK = 1_000
LEAST_Z = 6.0
MAX_ITER, REGULARISATION = 60, 1e-3
PARTS = 64
CHUNK = 1 << 20  # bytes of text at a time: about 100 bytes of arrays for each while learning
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def _hits(docs: Docs, wanted: np.ndarray | None) -> np.ndarray:
    """``document * SLOTS + slot`` of a chunk, ascending and distinct; only slots that ``wanted`` marks."""
    n = np.diff(docs.off)
    edge = docs.off + np.arange(len(docs.off))  # a space before each text, and one after the last
    text = np.full(len(docs.data) + len(docs.off), 32, np.uint8)
    inside = np.ones(len(text), bool)
    inside[edge] = False
    text[inside] = _FOLD[docs.data]
    eight = np.ndarray((len(text),), "<u8", np.concatenate([text, np.zeros(8, np.uint8)]), strides=(1,)).copy()
    out = []
    for k in GRAMS:
        gram = eight & U((1 << (8 * k)) - 1)
        slot = (((gram + U(k)) * GOLDEN) >> U(64 - SLOT_BITS)).astype(np.int64)
        at = np.flatnonzero(wanted[slot]) if wanted is not None else np.arange(len(slot))
        doc = np.searchsorted(edge, at, "right") - 1
        real = (doc < len(n)) & (at + k - 1 <= edge[np.minimum(doc + 1, len(n))])
        out.append(doc[real] * SLOTS + slot[at[real]])
    return distinct(np.concatenate(out))


class Model:
    """The weight of each slot (ratio times coefficient) and the intercept."""

    def __init__(self, weight: np.ndarray, intercept: float):
        self.weight, self.wanted, self.intercept = weight, weight != 0, float(intercept)

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for docs in chunks(column, CHUNK):
            hit = _hits(docs, self.wanted)
            size = len(docs.off) - 1
            out[docs.lo:docs.lo + size] = np.bincount(hit // SLOTS, weights=self.weight[hit % SLOTS], minlength=size)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(out + self.intercept)))


def _labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``(toxic, text)`` of at most ``limit`` labelled documents."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(limit))
    # the marks have at most ``limit`` rows of two numbers: a fixed bound
    return docs.join(F.broadcast(marks), "doc_id").select("toxic", F.coalesce("text", F.lit("")).alias("text"))


def _document_counts(rows: DataFrame) -> np.ndarray:
    """``(2, SLOTS)``: how many documents without and with the label have each slot. Each task sends its counts in ``PARTS``
    pieces; pieces are added up by number, and the driver gets ``PARTS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, SLOTS), np.int64)
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for docs in chunks(batch.column(1), CHUNK):
                hit = _hits(docs, None)
                for y in (0, 1):
                    count[y] += np.bincount(hit[toxic[docs.lo + hit // SLOTS] == y] % SLOTS, minlength=SLOTS)
        pieces = count.reshape(2, PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(
            [pieces[:, i].tobytes() for i in range(PARTS)], pa.binary())], names=["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group["counts"].to_pylist())
        return pa.table({"part": group["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = (rows.mapInArrow(run, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary"))
    got = sorted((r["part"], r["counts"]) for r in parts.collect())
    return np.concatenate([np.frombuffer(c, np.int64).reshape(2, -1) for _, c in got], axis=1)


def train(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> Model:
    """Learns from the rows of ``docs (doc_id, text)`` that ``labels (doc_id, toxic)`` marks."""
    rows = written(_labelled(docs, labels, limit).repartition(max(1, limit // PER_TASK)), "toxicity_labelled")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = size.get(1, 0), size.get(0, 0)
    flat = Model(np.zeros(SLOTS), np.log((toxic + 0.5) / (other + 0.5)))
    if not toxic or not other:
        return flat
    q, p = _document_counts(rows) + 1.0
    ratio = np.log(p / (toxic + 2)) - np.log(q / (other + 2))
    chosen = np.flatnonzero(np.abs(ratio) * np.sqrt(p) > LEAST_Z)
    if not len(chosen):
        return flat
    wanted = np.zeros(SLOTS, bool)
    wanted[chosen] = True
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # SLOTS flags

    def make(column):
        wanted = shared.value
        out: list[pa.Array] = []
        for d in chunks(column, CHUNK):
            hit = _hits(d, wanted)
            size = np.bincount(hit // SLOTS, minlength=len(d.off) - 1)
            names = pa.array(hit % SLOTS, pa.int32()).cast(pa.string())
            out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), names))
        return [pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.string()))]

    # presence of each chosen slot, then times its ratio: sparse vectors made by Spark's own transformers
    value = ratio[chosen]
    has = with_python_columns(rows, "text", [T.StructField("slots", T.ArrayType(T.StringType()))], make)
    has = has.select("slots", F.col("toxic").cast("double").alias("label"))
    present = CountVectorizerModel.from_vocabulary([str(x) for x in chosen.tolist()], "slots", "present").setBinary(True).transform(has)
    ready = ElementwiseProduct(scalingVec=Vectors.dense(value), inputCol="present", outputCol="features").transform(present)
    fitted = LogisticRegression(maxIter=MAX_ITER, regParam=REGULARISATION, standardization=False).fit(ready.select("features", "label"))
    weight = np.zeros(SLOTS)
    weight[chosen] = value * fitted.coefficients.toArray()
    return Model(weight, fitted.intercept)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with double column ``name``, 0 to 1; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers

    def make(column):
        return [pa.array(shared.value.scores(column), pa.float64())]

    return with_python_columns(docs, text, [T.StructField(name, T.DoubleType())], make)
