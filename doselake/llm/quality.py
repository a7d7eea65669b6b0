"""A quality classifier by importance resampling.

Texts are bags of hashed n-grams of four families: words and pairs of words (A-Z in lower
case), and shapes and pairs of shapes, where a shape says which kinds of characters a word
has, how many symbols, how long it is and whether it repeats the word before. Each family
has two generative models over `BUCKETS` buckets: one of the target text (documents
labelled good), one of the raw text (all documents). A document's importance weight is its
likelihood ratio, target over raw.

Documents are sampled without replacement by Gumbel top-k: log weight plus Gumbel noise,
largest first, which takes a document before another in proportion to their weights. How
many are taken is a parameter; left out, it is the number of target documents that the
weights lead to expect. Log weights are centred by a ratio per word (the models count what
they never saw like what is rare), which is set on the labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch, text
from .numbering import bucket_count, first_by

BUCKETS = 1 << 14
FAMILIES = 4
LABELLED_ROWS = 20_000  # the classifier is fitted on at most so many labelled rows
TEMPERATURE = 1.0  # of the Gumbel noise; 1 samples in proportion to the weights

Batches = Iterator[pa.RecordBatch]

_LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _WIDE = 1, 2, 4, 8, 16, 32
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord(c) for c in ".,;:?!'\"()-"]] = _STOP
_KIND[128:] = _WIDE


def _ngrams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams, (family, word), and where each row's words start."""
    data, offsets = text.flat(batch.column("text"))
    starts, ends, rows = text.word_bounds(data, offsets)
    out = np.zeros((FAMILIES, len(starts)), np.int64)
    if not len(starts):
        return out, rows
    hashes = text.hash_spans(text.lower(data), starts, ends)
    kind = _KIND[data]
    # Blanks after a word count to it in reduceat, so they must not count at all.
    kind[text.blank(data)] = 0
    mask = np.bitwise_or.reduceat(kind, starts)
    marks = np.minimum(np.add.reduceat(((kind & (_STOP | _SYMBOL)) > 0).astype(np.int64), starts), 3)
    length = np.minimum(np.log2(ends - starts).astype(np.uint64), np.uint64(7))
    first = np.zeros(len(starts), bool)
    first[rows[:-1][rows[:-1] < len(starts)]] = True
    before = np.roll(hashes, 1)
    before[first] = 0
    repeats = (before == hashes).astype(np.uint64)
    shape = mask.astype(np.uint64) | marks.astype(np.uint64) << np.uint64(6)
    shape |= repeats << np.uint64(8) | length << np.uint64(9)
    last = np.roll(shape, 1)
    last[first] = np.uint64(1 << 12)
    families = (
        hashes,
        text.mix(before * np.uint64(3) + hashes),
        text.mix(shape + np.uint64(1)),
        text.mix((last << np.uint64(13)) + shape + np.uint64(7)),
    )
    for i, values in enumerate(families):
        out[i] = (values >> np.uint64(20)) % np.uint64(BUCKETS)
    return out, rows


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences in all texts, (family, bucket): a task sends its sums, whatever it reads."""

    def run(batches: Batches) -> Batches:
        total = np.zeros((FAMILIES, BUCKETS), np.int64)
        for batch in text.slices(batches):
            grams, _ = _ngrams(batch)
            for family in range(FAMILIES):
                total[family] += np.bincount(grams[family], minlength=BUCKETS)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), pa.array(total.ravel()[place], pa.int64())],
            names=["place", "count"],
        )

    sums = docs.select("text").mapInArrow(run, "place long, count long").groupBy("place").agg(F.sum("count").alias("count"))
    found = sums.toArrow()  # at most FAMILIES * BUCKETS rows
    total = np.zeros(FAMILIES * BUCKETS, np.int64)
    total[found["place"].to_numpy()] = found["count"].to_numpy()
    return total.reshape(FAMILIES, BUCKETS)


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Logarithms of target over raw probability, with one occurrence added to each bucket."""
    share = [(c + 1.0) / (c + 1.0).sum(axis=1, keepdims=True) for c in (target, raw)]
    return np.log(share[0]) - np.log(share[1])


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Adds words and log_weight, the sum of all n-grams' log ratios, to (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Batches) -> Batches:
        table = held.value
        for batch in text.slices(batches):
            grams, rows = _ngrams(batch)
            sums = np.zeros(grams.shape[1] + 1)
            for family in range(FAMILIES):
                sums[1:] += table[family][grams[family]]
            # Summed per row, so that equal texts weigh the same wherever they are.
            weight = [float(sums[a + 1 : b + 1].sum()) for a, b in zip(rows[:-1], rows[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(rows), pa.int64()), pa.array(weight, pa.float64())],
                names=["doc_id", "words", "log_weight"],
            )

    return docs.mapInArrow(run, "doc_id long, words long, log_weight double")


def _best_cut(means: np.ndarray, good: np.ndarray) -> float:
    """The mean log ratio that parts good from bad labels best, in the middle of its gap."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(means, kind="stable")
    means, good = means[order], good[order]
    # Score of a cut before each value: bad ones below it and good ones from it on.
    below = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    above = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    inner = np.flatnonzero(means[1:] > means[:-1]) + 1
    if not len(inner):
        return -np.inf
    at = inner[np.argmax((below + above)[inner])]
    return float((means[at - 1] + means[at]) / 2)


def resample(weighed: DataFrame, take: int, temperature: float = TEMPERATURE, seed: int = 0) -> DataFrame:
    """Adds noisy and kept to stored rows (doc_id, words, margin): ``take`` of them by Gumbel top-k."""
    uniform = (F.abs(F.xxhash64(F.lit(seed), "doc_id") % (1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    noise = -F.log(-F.log(uniform))
    ranked = weighed.withColumn("noisy", F.col("margin") + F.lit(temperature) * noise).withColumn("_key", -F.col("noisy"))
    count = bucket_count(weighed.count())
    first = first_by(ranked, "_key", [F.col("doc_id"), F.col("words")], take, count)
    return first.drop("_key").withColumnRenamed("first", "kept")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    labelled_rows: int = LABELLED_ROWS,
    temperature: float = TEMPERATURE,
    seed: int = 0,
    take: int | None = None,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, words, log_weight, margin, noisy, kept.

    ``margin`` is the log weight less the centre times the words, the logarithm of the odds
    that a document is of the target. ``take`` documents are kept, by largest ``noisy``, the
    margin with Gumbel noise; without ``take``, as many as the odds lead to expect.

    The target and the centre come from the ``labelled_rows`` labelled documents of smallest
    hash; labels that are null count for nothing. With no good or no bad labels nothing is
    rejected unless ``take`` says so. Null and blank texts have no n-grams and margin 0; they
    are certain to be taken where ``take`` is left out. Repeated rows weigh the same and
    share their noise; ties go by id. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(labelled_rows)
    )
    labelled = scratch.store(rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled")).drop("_labelled"))
    ratios = log_ratios(ngram_counts(labelled.where("quality = 1")), ngram_counts(rows))
    fitted = weigh(labelled.select("doc_id", "text"), ratios).where("words > 0").join(
        F.broadcast(sample), F.col("doc_id") == F.col("_labelled")
    )
    fitted = fitted.select((F.col("log_weight") / F.col("words")).alias("mean"), F.expr("quality = 1").alias("good")).toArrow()
    centre = _best_cut(fitted["mean"].to_numpy(), fitted["good"].to_numpy().astype(bool))
    if np.isinf(centre):
        margin, chance = F.lit(0.0), F.lit(1.0)
    else:
        margin = F.col("log_weight") - F.lit(centre) * F.col("words")
        chance = F.when(F.col("words") > 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
    weighed = scratch.store(weigh(rows, ratios).withColumn("margin", margin))
    if take is not None:
        return _columns(resample(weighed, take, temperature, seed))
    some = weighed.where("words > 0")
    expected = some.agg(F.sum(chance)).first()[0]
    blank = weighed.where("words = 0").withColumns({"noisy": F.lit(float("inf")), "kept": F.lit(True)})
    return _columns(resample(some, round(expected or 0.0), temperature, seed).unionByName(blank))


def _columns(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "words", "log_weight", "margin", "noisy", "kept")


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` less what the classifier rejects, row by row: rows without an id, and those
    that share one, are judged by their own texts."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scratch.row_key().alias("_key"))
    labels = labelled.join(labels.select("doc_id", "quality"), "doc_id").select(F.col("_key").alias("doc_id"), "quality")
    return scratch.without(docs, classify(scratch.keyed(docs), labels, **options).where("not kept"))
