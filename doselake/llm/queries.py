"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import (
    chat,
    counting,
    decontaminate,
    fingerprints,
    mixing,
    neardup,
    negatives,
    packing,
    phrases,
    quality,
    scratch,
    sharding,
    sql,
    toxicity,
    training_order,
)

CONTROL_TEXT = r"\### Assistant: </turn> ok"
ROWS_PER_ARROW_BATCH = "512"  # whole texts; a batch must fit in a Python worker


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings that operators over whole texts need."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_ARROW_BATCH)
    return spark


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return training_order.materialise(docs, scratch.fresh(spark))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.messages(chat.log_of(rows)))


def op4_consistent_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op8_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return counting.recount(counting.trees(docs), edits_of(docs))


def edits_of(docs: DataFrame) -> DataFrame:
    """Three edits of every document: words struck out, words put in, and a line break."""
    size = F.coalesce(F.length("text"), F.lit(0))
    made = [
        (0, F.floor(size / 3), F.lit(12), F.lit("")),
        (1, F.floor(size / 2), F.lit(0), F.concat(F.lit(" revised in "), F.coalesce("source", F.lit("?")), F.lit(" "))),
        (2, F.floor(size * 3 / 4), F.lit(1), F.lit("\n")),
    ]
    changes = [
        F.struct(F.lit(seq).alias("seq"), at.cast("int").alias("start"), n.alias("length"), new.alias("insert"))
        for seq, at, n, new in made
    ]
    return docs.select("doc_id", F.inline(F.array(*changes)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4, similarity=80)


def op11_hyperplane_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), relabel_every=7)


def op12_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"), packing.Capacity(tokens=2048))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_training_order": op2_training_order,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_consistent_hash_shards": op4_consistent_hash_shards,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_improbable_features": op7_improbable_features,
    "op8_edit_aware_counts": op8_edit_aware_counts,
    "op9_toxicity": op9_toxicity,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_hyperplane_tree": op11_hyperplane_tree,
    "op12_vector_best_fit": op12_vector_best_fit,
    "op13_son_collocations": op13_son_collocations,
}

ORACLE_SQL = {
    "op1_pareto_mix": sql.pareto_mix(),
    "op3_chat_formatting": sql.chat_formatting(CONTROL_TEXT),
    "op10_minhash_near_dedup": sql.near_duplicates(words=4, similarity=80),
    "op11_hyperplane_tree": sql.hard_negatives(),
    "op13_son_collocations": sql.collocations(),
}
