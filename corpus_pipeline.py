"""Corpus preparation pipeline over ``documents``: five stages, each written as Parquet and read again by the next one.

1. quality rules: documents that a rule rejects go;
2. MinHash near-duplicates (80 % of the shingles or more): one document of each group stays, the one with the least id;
3. suffix-array dedup: strings of 200 bytes that occur elsewhere are cut out of the texts, ``n_chars`` follows the text;
4. benchmark decontamination: documents that hold a benchmark passage go;
5. byte-level BPE: each document's ids, its token count and the digests of ids and decoded bytes.

A stage sees what its predecessor kept, with all columns of ``documents``; the last returns ``doc_id``, ``ids`` and what is derived from them. NULLs, empty
texts, repeated rows and empty tables are treated as each operator's module says; a row that repeats another entirely goes in stage 2.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm import byte_bpe, decontaminate, near_duplicates, quality, repeats
from stationcast.llm.common import table, written


NEAR_PERCENT = 80  # of this stage; op1 alone takes 85


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.without_duplicates(docs, percent=NEAR_PERCENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, ids=True).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no byte-pair encoder; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
