"""The corpus pipeline: from raw documents to balanced shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the columns of ``documents``; the
last one adds ``shard``. Every stage works on all rows of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doclake.llm import decontaminate, language_id, mixing, near_dedup, sharding
from doclake.runtime import stored

SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class."""
    return near_dedup.without_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half the tokens, with smoothed shares of sources, languages and topics."""
    return mixing.mixed(docs)


def put_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their shard."""
    return sharding.with_shards(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", put_into_shards),
]

#: No SQL: the stages learn models, align texts, iterate and pack. tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, f"pipeline-{name}")
    return docs
