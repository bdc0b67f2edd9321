"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, hard_negatives, interpolated_lm, licenses, near_duplicates, prefix_trie, quality, repeats, sharding, token_counts, toxicity, warc
from .common import table
from .oracle import SQL  # noqa: F401  the queries that DuckDB can answer


def _fold(n: int) -> Column:
    """crc32 of doc_id as text, modulo ``n``; a NULL id is in no fold."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its near-duplicate group and whether it stays."""
    return near_duplicates.groups(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document regions near a benchmark passage: ``doc_id, item_id, start, end, edits``."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the base counts, its distances to the language references and the verdict."""
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its token count and digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, path, public_tokenizers.PATTERN).drop("text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its toxicity score; labels of the fold 2 of 4 are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"))
    model = toxicity.train(docs.where(~F.col("held_out")).select("doc_id", "text"),
                           table(spark, sf_dir, "labels").where(_fold(4) != 2))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its licence phrases, the labels of fuzzy notices and their spans."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page its record, as read back from the normalised archives."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).drop("archive")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the bytes covered by 200-byte strings that occur elsewhere."""
    return repeats.summary(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of tokens under the pieces and scores of the 32k vocabulary, as a unigram model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its log10 probability under the add-half unigram base and the interpolated bigram model."""
    held = F.coalesce(_fold(5) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"), (~held).alias("learn"))
    return interpolated_lm.score(docs, ["doc_id", "held_out"], "learn")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor and positive the first hard negatives."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its place in 8 shards of near equal bytes, equal texts together."""
    return sharding.shards(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node of the trie of rebuilt conversations its members, children, leaves and saved bytes."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_decontamination, op3_quality_rules, op4_byte_bpe, op5_toxicity, op6_license_scan, op7_warc, op8_suffix_dedup, op9_token_counts, op10_lm_scoring,
    op11_hard_negatives, op12_sharding, op13_prefix_trie,
)}
