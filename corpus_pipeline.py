"""Corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of docs:
documents that fail the rules go; repeated lines go, and documents that had nothing
else; of each group of near copies the smallest doc_id stays; documents that hold a
benchmark passage go. The last stage encodes what is left and decodes it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_rules
from shelfspark.llm.common import saved, ship


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.drop_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark),
    ("byte_bpe", encode),
]

#: SimHash groups, latent retrieval and BPE cannot be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
