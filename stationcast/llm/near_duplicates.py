"""Near-duplicate groups by SuperMinHash: signatures, banding, verification on full shingle sets, union-find grouping.

Words are lower-cased (A-Z) and separated by white space; a document's set holds its distinct runs of ``words`` words (of fewer
words, the whole sequence). Two documents are linked when 100 |A n B| >= percent |A u B|.

1. One pass over the texts writes the set size, a 128-bit key of the set, the band keys and a sketch of one byte per
   signature position. Equal sets form a class, represented by its least ``doc_id``; only representatives go on.
2. In each band bucket every member is paired with the least one (its hub), never all with all. Pairs whose sizes rule a
   link out, or whose sketches agree too seldom (six standard deviations below the threshold), fall away.
3. The other pairs are verified on the full sets; the links' components are found (``components``).
4. Buckets whose members are not yet one component may hold links that miss the hub. Their documents are searched exactly: with
   tokens in order of frequency, two linked sets share a token among the first n - ceil(t n) + 1 of each, at places
   that allow the overlap. Only pairs of different components are emitted and verified, and the components found again.

With 30 bands of 5 rows, a pair at 85 % misses every bucket with chance 2e-8, one at 80 % with 7e-6.

Defined cases: a NULL or empty text, or white space alone, has an empty set and is linked with nothing; a NULL ``doc_id`` takes
no part (its component is NULL, and it is kept); a repeated row is a copy like any other; rows with one id and
different texts are linked each by its own text; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from . import superminhash as M
from .common import discard, written
from .components import components
from .text_arrays import U, chunks, distinct, lowered, mix, shingles, tally

WORDS = 5
PERCENT = 85
BANDS, ROWS = 30, 5
TOKENS = 1


def _key(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set, whatever its order."""
    a, b = mix(s + U(1)).sum(dtype=np.uint64), mix(s ^ U(0x5DEECE66D)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, bands, sketch``; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column(1)):
                sets = shingles(lowered(c.data), c.off, words)
                sig = M.signatures(sets, bands * rows)
                keys = [_key(s) for s in sets]
                full = [len(s) > 0 for s in sets]
                buckets, sketch = M.bands(sig, rows).astype(np.int64), M.sketch(sig)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(c.lo, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([b if f else None for b, f in zip(buckets, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in sketch], pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch binary")


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Of ``(a, b, sa, sb)``, the pairs whose sketches agree in ``least`` of the positions or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                keep = pa.array((sa == sb).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return pairs.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``cid, cset``: the full sets (sorted hashes, 8 bytes each) of the documents in ``ids (cid)``; of copies under one
    id, one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column(1)):
                sets = shingles(lowered(c.data), c.off, words)
                keys = [_key(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(c.lo, len(sets)), pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["cid", "k1", "k2", "cset"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("cid"), "text").join(ids, "cid", "left_semi")
    return (wanted.mapInArrow(run, "cid long, k1 long, k2 long, cset binary")
            .groupBy("cid", "k1", "k2").agg(F.first("cset").alias("cset")).select("cid", "cset"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of ``(a, b)``, the links ``(u, v)``: pairs with 100 |A n B| >= percent |A u B| on the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("cid").alias("a"), F.col("cset").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("cset").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "u long, v long")


def _across(open_sets: DataFrame, percent: int) -> DataFrame:
    """Exact candidates ``(a, b)`` of different components among ``(cid, label, cset)``, by prefixes of rare tokens."""
    packed = B.pack(open_sets.select("cid", "label", "cset"))

    def split(rows: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["cset"].combine_chunks()] if len(rows) else []

    def ask(rows, _):
        sets = split(rows)
        return {TOKENS: tally(np.concatenate(sets) if sets else np.zeros(0, np.uint64))}

    def prefix(rows: pa.Table, totals: dict[int, np.ndarray], _: int) -> pa.Table:
        sets = split(rows)
        known = distinct(np.concatenate(sets))
        out: list[list] = [[], [], [], [], []]
        for cid, label, s in zip(rows["cid"].to_pylist(), rows["label"].to_pylist(), sets, strict=True):
            often = totals[TOKENS][np.searchsorted(known, s)]
            first = np.lexsort((s, often))[:len(s) - math.ceil(percent * len(s) / 100) + 1]
            place = np.flatnonzero(often[first] > 1)
            out[0] += s[first[place]].astype(np.int64).tolist()
            out[4] += place.tolist()
            for k, x in ((1, cid), (2, label), (3, len(s))):
                out[k] += [x] * len(place)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["token", "cid", "label", "n", "place"])

    found = written(B.answered(packed, B.count(packed, ask, name="token_counts"), prefix,
                               "token long, cid long, label long, n long, place long"), "prefixes")
    mixed = (found.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo <> hi").select("token"))
    left = found.join(mixed, "token", "left_semi")
    right = left.select("token", *[F.col(c).alias(c + "2") for c in ("cid", "label", "n", "place")])
    overlap = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    return (left.join(right, "token")
            .where((F.col("cid") < F.col("cid2")) & (F.col("label") != F.col("label2"))
                   & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
                   & ((100 + percent) * overlap >= percent * (F.col("n") + F.col("n2"))))
            .select(F.col("cid").alias("a"), F.col("cid2").alias("b")).distinct())


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    sig = written(signatures(docs, words, bands, rows).withColumn("row", F.monotonically_increasing_id()), "signatures")
    full = sig.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["k1", "k2", "n_shingles"]
    classes = written(full.groupBy(*key).agg(F.min(F.struct("doc_id", "row")).alias("rep"))
                      .select(*key, F.col("rep.doc_id").alias("cid"), F.col("rep.row").alias("row")), "classes")
    reps = full.join(classes.select("row"), "row", "left_semi").withColumnRenamed("doc_id", "cid")  # one row, however many copies
    hubs = (full.select("doc_id", "k1", F.explode("bands").alias("band")).groupBy("band")
            .agg(F.min("doc_id").alias("hub"), F.min("k1").alias("lo"), F.max("k1").alias("hi"))
            .where("lo <> hi").select("band", "hub"))
    members = written(reps.select("cid", F.explode("bands").alias("band")).join(hubs, "band"), "band_members")
    active = members.select("cid").distinct()
    sketches = written(reps.join(active, "cid", "left_semi").select("cid", "n_shingles", "sketch"), "sketches")
    sets = written(_sets(docs, active, words), "full_sets")

    t = percent / 100
    m = bands * rows
    least = t - 6 * math.sqrt(t * (1 - t) / m)
    left, right = (sketches.select(F.col("cid").alias(i), F.col("n_shingles").alias("n" + i), F.col("sketch").alias("s" + i)) for i in "ab")
    pairs = (members.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
             .join(left, "a").join(right, "b")
             .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb"))
    links = written(verified(_alike(pairs, least), sets, percent), "hub_links")
    label = written(components(links), "components")

    labelled = (members.join(label.withColumnRenamed("node", "cid"), "cid", "left")
                .select("band", "cid", F.coalesce("component", "cid").alias("label")))
    unsettled = (labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo <> hi").select("band"))
    still = labelled.join(unsettled, "band", "left_semi").select("cid", "label").distinct()
    more = written(verified(_across(sets.join(still, "cid"), percent), sets, percent), "other_links")
    if not more.isEmpty():
        label = written(components(links.unionByName(more)), "components")
    discard(members, sketches, sets, links, more)

    return (sig.select("doc_id", *key).join(classes.drop("row"), key, "left")
            .join(label.withColumnRenamed("node", "cid"), "cid", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "cid", "doc_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def without_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents whose id names their group, each once; rows without an id stay."""
    kept = groups(docs, **options).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    have = docs.where(F.col("doc_id").isNotNull()).join(kept, F.col("doc_id") == F.col("__id"), "left_semi")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    once = (have.withColumn("__copy", F.row_number().over(Window.partitionBy("doc_id", text).orderBy("text")))
            .where("__copy = 1").select(*docs.columns))
    return once.unionByName(docs.where(F.col("doc_id").isNull()))
