"""The corpus pipeline: quality, near-duplicates, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``. Stages but the last keep the columns
of ``documents``. The first three judge every row by its own text: rows without an id, and
rows that share one, are filtered like all others, and of rows that repeat id and text one
stays. Null and empty texts pass these stages, and the mix takes none of their words, so they
end there; empty tables pass all stages empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from doselake.llm import decontaminate, mixing, neardup, quality, queries, scratch, sharding

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance weights accept."""
    queries.ready(spark)
    return quality.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    queries.ready(spark)
    return neardup.keep_one(docs, words=5, similarity=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a few edits."""
    queries.ready(spark)
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them."""
    queries.ready(spark)
    return mixing.mixed(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and its place there."""
    queries.ready(spark)
    return sharding.shard(docs, shards=8)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mix_stage),
    ("sharding", shard_stage),
]

#: The classifier and the ring are beyond SQL; tests/llm/test_pipeline.py compares every stage
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return docs
