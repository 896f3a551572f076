"""The corpus pipeline: quality classifier, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of documents. Stages match rows by doc_id and a hash of the text, so
repeated ids are told apart. No SQL stands for the whole (a classifier is fitted, similarities are searched for); the tests
hold run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelsieve.llm import decontam, mixing, quality, sharding, simhash
from reelsieve.llm.common import materialize, table


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return simhash.keep_one(docs, width=5, min_similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is similar to a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is there as often as the mix takes it, written in the order of the mix's shards."""
    return mixing.in_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard; the copies of a document that the mix takes twice lie apart."""
    return sharding.assign(docs, keep=True)


STAGES = [
    ("quality_classifier", classified),
    ("simhash_near_dedup", deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("source_mix", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
