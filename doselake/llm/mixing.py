"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target in words. A document is wanted ``target / source size`` times:
its whole copies are certain, the rest of that ratio is its inclusion chance. Documents
are ranked by ``odds(random) / odds(chance)``, smallest first, and taken in that order
until the source's remaining words are used up (the crossing document is taken if that
comes nearer). The sample's size in words is thus fixed, whatever the chances are.

A column of preferences makes the chances unequal; they keep their proportions up to the
limit of ``max_copies``. Randoms are hashes of document id and seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch
from .numbering import bucket_count
from .text import WORD

_RANDOM_BITS = 52


def words(column: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """(source, weight): 1, 2, ..., ``cycle``, repeating, by code point, null last.

    ``sizes`` has a row per source, so the order is one of sources, not of documents.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sizes.select("source", ((nth - 1) % cycle + 1).cast("long").alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, total: int, max_copies: int) -> DataFrame:
    """(source, source_size, target) of sources with ``source_size`` and ``weight``.

    ``total`` words are shared by weight. No target exceeds ``max_copies`` times its
    source; what is cut off goes to the others by weight, until none is above. That
    settles at one level of words per weight: sources whose limit per weight lies below
    it get their limit. The level is found from one running sum over sources.
    """
    rows = (
        sizes.join(weights.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_limit", F.col("source_size") * max_copies)
        .withColumn("_rate", F.col("_limit") / F.nullif(F.col("weight"), F.lit(0)))
    )
    order = Window.orderBy("_rate", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    rows = (
        rows.withColumn("_given", F.coalesce(F.sum("_limit").over(before), F.lit(0)))
        .withColumn("_share", F.sum("weight").over(after))
        .withColumn("_level", (F.lit(total).cast("long") - F.col("_given")) / F.nullif(F.col("_share"), F.lit(0)))
        .withColumn("_open", F.col("_level") < F.col("_rate"))
        .withColumn("_final", F.max(F.when(F.col("_open"), -F.col("_given"))).over(Window.partitionBy()))
        .withColumn("_at", F.max(F.when(-F.col("_given") == F.col("_final"), F.col("_level"))).over(Window.partitionBy()))
    )
    capped = F.col("_final").isNull() | (-F.col("_given") > F.col("_final"))
    target = F.when(capped, F.col("_limit").cast("double")).otherwise(F.col("weight") * F.col("_at"))
    return rows.select("source", "source_size", target.alias("target"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from a document's id; null is an id like others."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    bits = F.conv(F.substring(digest, 1, _RANDOM_BITS // 4), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << _RANDOM_BITS))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: DataFrame | None = None,
    share: float = 1.0,
    max_copies: int = 3,
    preference: str | None = None,
    seed: str = "mix",
) -> DataFrame:
    """A row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``weights`` is (source, weight); without it, weights cycle through 1, 2, 3 by source.
    The targets share ``share`` of all sizes. ``copies`` is how often the mix repeats the
    document, ``taken`` its size times that, at most ``max_copies`` times the size.

    A null source is a source. Documents of size 0 weigh nothing and are never taken.
    Repeated rows are drawn alike up to the crossing one. Rows without an id share one
    random number and are ordered by size. Null or negative preferences count as 0; a
    source whose preferences cannot reach its target takes all that they allow. Empty
    tables give no rows. Other columns are ignored.
    """
    # One pass over the texts; what follows reads a few columns of it.
    rows = scratch.store(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            (words(F.col("text")) if size is None else size.cast("long")).alias("size"),
            (
                F.lit(1.0)
                if preference is None
                else F.greatest(F.coalesce(F.col(preference).cast("double"), F.lit(0.0)), F.lit(0.0))
            ).alias("preference"),
        )
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count("*").alias("rows"),
        F.sum(F.col("size") * F.col("preference")).alias("preferred"),
    )
    sizes = scratch.store(sizes)
    count, words_in_all = sizes.agg(F.sum("rows"), F.sum("source_size")).first()
    total = int((words_in_all or 0) * share)
    if weights is None:
        weights = cyclic_weights(sizes)
    goals = targets(sizes, weights, total, max_copies)
    goals = goals.join(
        sizes.select(F.col("source").alias("_source"), "preferred"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    goals = scratch.store(goals)

    named = goals.withColumnRenamed("source", "_source")
    if preference is None:
        ratio = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    else:
        ratio = F.col("preference") * F.col("target") / F.nullif(F.col("preferred"), F.lit(0.0))
    wanted = (
        rows.join(named, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("wanted", F.coalesce(F.least(ratio, F.lit(float(max_copies))), F.lit(0.0)))
        .withColumn("wanted", F.when(F.col("size") > 0, F.col("wanted")).otherwise(0.0))
        .withColumn("whole", F.floor("wanted").cast("long"))
        .withColumn("chance", F.col("wanted") - F.col("whole"))
    )
    draw = uniform(F.col("doc_id"), seed)
    odds = draw / (F.lit(1.0) - draw) / F.nullif(F.col("chance") / (F.lit(1.0) - F.col("chance")), F.lit(0.0))
    ranked = wanted.withColumn("rank", F.when(F.col("chance") > 0, odds))
    return _taken(ranked, bucket_count(count or 0))


def _taken(ranked: DataFrame, buckets: int) -> DataFrame:
    """Adds one more copy to the documents that come first by rank, up to the target.

    Ranks are dealt to buckets by their place in (0, 1), ``rank / (1 + rank)``, and a
    bucket's words are summed map-side. Buckets before the one that crosses the target are
    taken whole; only inside the crossing bucket is every document looked at in order.
    """
    place = F.floor(F.col("rank") / (F.lit(1.0) + F.col("rank")) * buckets)
    rows = ranked.withColumn("_bucket", F.when(F.col("rank").isNotNull(), place))
    sums = rows.groupBy("source", "_bucket").agg(
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size"))).alias("words"),
        F.sum(F.col("size") * F.col("whole")).alias("certain"),
        F.first("target").alias("goal"),
    )
    in_all = Window.partitionBy("source")
    before = in_all.orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"),
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_before"),
        F.col("words").alias("_words"),
        (F.col("goal") - F.sum("certain").over(in_all)).alias("_rest"),
    ).where("_of is not null")
    rows = rows.join(
        sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_of")), "left"
    )
    crossing = F.expr("_before < _rest and _before + _words > _rest")
    # Rows outside the crossing bucket need no order: they are spread over many groups.
    spread = F.when(F.coalesce(crossing, F.lit(False)), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets * 4))
    )
    inside = (
        Window.partitionBy("source", "_bucket", "_spread")
        .orderBy("rank", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("_spread", spread).withColumn(
        "_ahead", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    nearer = F.expr("_ahead < _rest and (_ahead + size - _rest) <= (_rest - _ahead)")
    one_more = F.when(crossing, nearer).otherwise(F.expr("_before < _rest"))
    copies = F.col("whole") + F.when(F.coalesce(one_more, F.lit(False)), 1).otherwise(0)
    return rows.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    own, origin, size, rows, copies, nth, copy = scratch.unused(
        docs, "_own", "_origin", "_size", "_rows", "_copies", "_nth", "_copy"
    )
    plan = mix(docs, **options)
    once = plan.groupBy(
        F.col("doc_id").alias(own), F.col("source").alias(origin), F.col("size").alias(size)
    ).agg(F.count("*").alias(rows), F.sum("copies").alias(copies))
    same = (
        F.col("doc_id").eqNullSafe(F.col(own))
        & F.col("source").eqNullSafe(F.col(origin))
        & (words(F.col("text")) == F.col(size))
    )
    taken = docs.join(once.where(f"{copies} > 0"), same)
    # Rows alike in id, source and size share their copies out among themselves.
    alike = Window.partitionBy(own, origin, size).orderBy(F.xxhash64("text"))
    taken = taken.withColumn(nth, F.when(F.col(rows) > 1, F.row_number().over(alike)).otherwise(1))
    each = F.expr(f"array_repeat(0, int({copies} div {rows}) + if({nth} <= {copies} % {rows}, 1, 0))")
    return taken.select(*scratch.columns(docs), F.explode(each).alias(copy)).drop(copy)
