"""Quality rules from distribution divergence, in DataFrame functions only.

Two histograms describe a document: its characters by class (lower-case and other letters, capitals, digits, white space,
punctuation, symbols, other) and its common words (one bin per word of ``COMMON_WORDS`` and one for all others). The
reference of a language is the mean histogram over all documents with that ``lang`` (NULL is a language of its own), each
document counting the same; it is summed in whole millionths, so it does not depend on the order of rows. A document is
rejected when the Jensen-Shannon distance (base 2, 0 to 1) to its reference exceeds the rule's limit, provided that
it has the rule's minimum length; shorter documents give too coarse a histogram and pass.

Base rules: fewer than ``min_words`` words, or more than 30 % of the words in repeated 8-word windows.

Defined cases: a NULL or empty text has zero words, every count 0, and fails the base rule; a repeated row is judged
again, alike; a NULL ``doc_id`` is carried through; an empty table gives no row. Windows are compared by two
hashes (96 bits) of their eight words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "des", "auf", "ist",
    "de", "la", "le", "et", "les", "en", "du", "un", "une", "que", "est", "pour",
    "el", "y", "los", "las", "se", "del", "por", "con", "no", "una", "su", "para",
]
CLASSES = ["lower", "upper", "digit", "space", "punctuation", "symbol", "other"]
CLASS_LIMIT, CLASS_MIN_CHARS = 0.3, 300
WORD_LIMIT, WORD_MIN_WORDS = 0.4, 100
MILLION = 1_000_000


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _window_hash(w: Column, i: Column, fn) -> Column:
    return fn(*[F.get(w, i + k) for k in range(WINDOW)])


def _repeat_words(w: Column) -> Column:
    """Words covered by the 8-word windows that occur twice or more."""
    n = F.size(w) - (WINDOW - 1)
    starts = F.sequence(F.lit(0), n - 1)

    def covered(h: Column) -> Column:
        entries = F.sort_array(F.transform(h, lambda x, i: F.struct(
            x.alias("h"), _window_hash(w, i, F.hash).alias("g"), i.alias("i"))))

        def marked(s: Column) -> Column:
            same = lambda e, o: (e["h"] == o["h"]) & (e["g"] == o["g"])
            hit = F.filter(s, lambda e, j: F.coalesce(same(e, F.get(s, j - 1)), F.lit(False))
                           | F.coalesce(same(e, F.get(s, j + 1)), F.lit(False)))
            return let(F.sort_array(F.transform(hit, lambda e: e["i"])), lambda at: _sum(F.transform(
                at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(entries, marked))

    return F.when(n < 2, F.lit(0)).otherwise(let(F.transform(starts, lambda i: _window_hash(w, i, F.xxhash64)), covered))


def _common_counts(w: Column) -> Column:
    """Per common word how often it occurs: each kept word gets blanks of its own, then whole words are taken out."""
    kept = F.filter(w, lambda x: F.lower(x).isin(COMMON_WORDS))
    padded = F.concat(F.lit(" "), F.lower(F.array_join(kept, "  ")), F.lit(" "))
    return let(padded, lambda p: let(F.octet_length(p), lambda size: F.array(*[
        F.floor((size - F.octet_length(F.replace(p, F.lit(f" {x} "), F.lit("")))) / (len(x) + 2)).cast("int")
        for x in COMMON_WORDS])))


def _class_counts(text: Column) -> Column:
    """Characters by class. Classes are taken out one after the other, the most frequent first, so that later passes go
    over short remainders."""
    steps = [("lower", "[a-z]+"), ("space", r"[\s\x0B]+"), ("upper", r"\p{Lu}+"), ("lower", r"\p{L}+"), ("digit", r"\p{N}+"),
             ("symbol", r"[#*$%&|<>]+"), ("punctuation", r"[.,;:!?'\"()-]+")]

    def step(rest: Column, todo: list, got: list) -> Column:
        if not todo:
            size = {c: [n for k, n in got if k == c] for c in CLASSES}
            size["other"].append(F.char_length(rest))
            return F.array(*[reduce(lambda a, b: a + b, size[c]) for c in CLASSES])
        (name, pattern), later = todo[0], todo[1:]
        return let(F.regexp_replace(rest, pattern, ""), lambda left: step(
            left, later, [*got, (name, F.char_length(rest) - F.char_length(left))]))

    return let(text, lambda t: step(t, steps, []))


def features(docs: DataFrame, name: str = "features") -> DataFrame:
    """``docs`` and struct ``name`` of base counts and histograms; row-local. The struct comes out of a generator, below which no
    later filter is pushed: it would compute the struct again for each condition."""
    return docs.withColumn(name, F.explode_outer(F.array(let(F.coalesce(F.col("text"), F.lit("")), lambda text: F.struct(
        let(F.filter(F.split(text, SPACE), lambda x: x != ""), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            _common_counts(w).alias("common"))).alias("words"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: (
            F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.char_length(text).cast("long").alias("n_chars"),
        _class_counts(text).alias("classes"))))))


def _millionths(counts: Column, total: Column) -> Column:
    """Shares of ``total`` in whole millionths (0 of nothing)."""
    return F.transform(counts, lambda c: F.when(total > 0, F.floor(c.cast("long") * F.lit(MILLION) / total)).otherwise(0).cast("long"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, base 2."""
    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def _shares(f: str) -> tuple[Column, Column]:
    """The two histograms of a document in millionths."""
    words = F.col(f)["words"]
    other = words["n_words"] - _sum(words["common"])
    return (_millionths(F.col(f)["classes"], F.col(f)["n_chars"]),
            _millionths(F.concat(words["common"], F.array(other.cast("int"))), words["n_words"]))


def references(featured: DataFrame, name: str = "features", lang: str = "lang") -> DataFrame:
    """``lang``, and the mean histograms ``ref_classes`` and ``ref_words`` over all its documents with a word."""
    bins = [("c", len(CLASSES)), ("w", len(COMMON_WORDS) + 1)]
    classes, common = _shares(name)
    shares = featured.where(F.col(name)["words"]["n_words"] > 0).select(
        F.col(lang).alias("ref_lang"), classes.alias("c"), common.alias("w"))
    total = shares.groupBy("ref_lang").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.col(a)[i]).alias(f"{a}{i}") for a, n in bins for i in range(n)])
    mean = lambda a, n: F.array(*[F.col(f"{a}{i}") / (F.col("n") * MILLION) for i in range(n)])
    return total.select("ref_lang", mean(*bins[0]).alias("ref_classes"), mean(*bins[1]).alias("ref_words"))


def judge(featured: DataFrame, refs: DataFrame, name: str = "features", lang: str = "lang", min_words: int = MIN_WORDS,
          class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """``featured`` with ``base_failed``, ``class_distance``, ``word_distance`` and ``kept``. ``refs`` has a row per language:
    the planner broadcasts it by its measured size or splits the skewed side of a sort-merge join."""
    f = F.col(name)
    share = lambda col: F.transform(col, lambda x: x / F.lit(float(MILLION)))
    classes, common = _shares(name)
    joined = featured.join(refs, F.col(lang).eqNullSafe(F.col("ref_lang")), "left")
    out = (joined
           .withColumn("base_failed", (f["words"]["n_words"] < min_words)
                       | (100 * f["words"]["n_repeat_words"] > REPEAT_PERCENT * f["words"]["n_words"]))
           .withColumn("class_distance", F.round(F.coalesce(js_distance(share(classes), F.col("ref_classes")), F.lit(0.0)), 6))
           .withColumn("word_distance", F.round(F.coalesce(js_distance(share(common), F.col("ref_words")), F.lit(0.0)), 6)))
    far = (((f["n_chars"] >= CLASS_MIN_CHARS) & (F.col("class_distance") > class_limit))
           | ((f["words"]["n_words"] >= WORD_MIN_WORDS) & (F.col("word_distance") > word_limit)))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, distances and verdict. The features (a few hundred bytes a document) are written
    once: both the references and the verdicts read them."""
    featured = written(features(docs.select("doc_id", "lang", "text")).drop("text"), "quality_features")
    refs = written(references(featured), "quality_references")
    f = F.col("features")
    return judge(featured, refs).select(
        "doc_id", f["words"]["n_words"].alias("n_words"), f["words"]["word_chars"].alias("word_chars"),
        f["n_symbols"].alias("n_symbols"), f["n_dup_lines"].alias("n_dup_lines"),
        f["words"]["n_repeat_words"].alias("n_repeat_words"), "base_failed", "kept", "class_distance", "word_distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that every rule keeps, with their own columns. The features are computed twice, for the references and for the
    verdicts: cheaper than writing the texts beside them."""
    hidden = docs.toDF(*[f"d{i}" for i in range(len(docs.columns))])
    at = {n: f"d{i}" for i, n in enumerate(docs.columns)}
    featured = features(hidden.withColumn("text", F.col(at["text"])).withColumn("lang", F.col(at["lang"])))
    refs = written(references(featured.select("lang", "features")), "quality_references")
    kept = judge(featured.drop("text"), refs).where("kept")
    return kept.select(*[F.col(f"d{i}").alias(n) for i, n in enumerate(docs.columns)])
