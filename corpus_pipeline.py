"""From raw documents to training shards: classify, deduplicate, decontaminate, mix, shard.

Every stage reads its predecessor's Parquet output and works on all of it; all but the last
return the columns of the documents. Stages pass extra columns through, keep documents with null
or empty texts unless their own rule rejects them, and turn an empty table into an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.llm import decontaminate, mixing, near_dedup, quality, sharding
from macrospark.llm.common import ready, table, written

SHARDS = 16
#: Toxic text is thinned out; what is clean keeps its tokens.
TARGETS = {"clean": 0.98, "toxic": 0.02}


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least doc_id."""
    ready(spark)
    return near_dedup.one_per_class(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; rows may be left out or repeated."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), targets=TARGETS, domain=domain)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the shard of each document; a function of its doc_id alone."""
    return sharding.with_shard(docs, "doc_id", [1.0] * SHARDS)


STAGES = [
    ("quality_classifier", classify),
    ("near_dedup", deduplicate),
    ("decontaminate", decontaminated),
    ("mix", mix),
    ("shard", shard),
]

#: The classifier and the samples have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
