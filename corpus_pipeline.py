"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terracover.llm import bpe, decontaminate, neardup, pii, quality
from terracover.llm.common import new_path, read_table, remove_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled cutoff rejects go."""
    return quality.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, similarity 0.8)."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    return pii.redact(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left (token_ids: little-endian, 32 bits), with digests of ids and decoded text."""
    return bpe.bpe_digest(docs, bpe.vocabulary_path(), keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bpe", bpe_tokens),
]

#: SQL expresses neither the risk-controlled cutoffs nor BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            remove_path(spark, before)
            before = path
    return docs
