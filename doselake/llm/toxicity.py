"""Toxicity by a bidirectional gated recurrent network, trained in numpy.

A word's input is its own embedding plus the mean embedding of its character n-grams
(both hashed; only what at least `LEAST_TEXTS` fitted texts have is embedded), so words
never seen are read by their characters. An embedding starts from how much commoner its word
or n-gram is among toxic texts than chance explains, and in training half of the words are
read by their characters alone; both keep small samples from being learned by heart. A gated recurrent network reads each window of
`WINDOW` words both ways, attention pools its states, and a text's score is that of its
most toxic window. Windows overlap by half and cover all of a text, so
`WINDOW` - `STRIDE` + 1 words running lie whole in one of them wherever they stand.

The model is fitted on the driver, on at most `TOXIC_ROWS` and `OTHER_ROWS` labelled texts
of at most `FIT_BYTES` bytes, and sent to the tasks (about 6 MB, whatever the input).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch, text

WINDOW = 32
STRIDE = 16
WORDS = 1 << 18  # buckets; only those that enough fitted texts have get an embedding
GRAMS = 1 << 20
LEAST_TEXTS = 3
GRAM_SIZES = (4, 6)
INPUT = 12
HIDDEN = 8
ATTENTION = 8
TOXIC_ROWS = 1000
OTHER_ROWS = 2000
FIT_BYTES = 4000
STEPS = 120  # however many texts there are
CHANCE = 2.0  # standard errors of a word's odds that mean nothing
CERTAIN = 4.0  # further ones that mean all a word can say
EVIDENCE = 4.0  # how far from zero that puts its embedding
FEW = 250  # toxic texts; with fewer, embeddings are learned more slowly, in proportion
DROPPED = 0.5  # share of words whose own embedding is left out at a step
TEXTS_PER_STEP = 64
RATE = 0.01
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20
_WINDOWS_AT_ONCE = 4096

Batches = Iterator[pa.RecordBatch]
Params = dict[str, np.ndarray]


class Words:
    """The words of some texts: features of the distinct ones, and which one is where."""

    def __init__(self, column: pa.Array):
        data, offsets = text.flat(column)
        data = text.lower(data)
        starts, ends, self.rows = text.word_bounds(data, offsets)
        hashes = text.hash_spans(data, starts, ends)
        distinct, first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct % np.uint64(WORDS)).astype(np.int64)
        self.gram, self.gram_of = _grams(data, starts[first], ends[first])
        self.grams = np.bincount(self.gram_of, minlength=len(self.word))

    def embedded(self, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The embedding of each word (0: none), and all embeddings of n-grams with their words."""
        gram = params["gram_of_bucket"][self.gram]
        known = np.flatnonzero(gram)
        return params["word_of_bucket"][self.word], gram[known], self.gram_of[known]

    def windows(self, stride: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of each window (the number of words where there is none), and its row."""
        lengths = np.diff(self.rows)
        counts = np.where(lengths > 0, np.maximum(-(-(lengths - WINDOW) // stride), 0) + 1, 0)
        row = np.repeat(np.arange(len(lengths)), counts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = (self.rows[:-1][row] + nth * stride)[:, None] + np.arange(WINDOW)
        known = at < self.rows[1:][row][:, None]
        none = len(self.word)
        which = np.append(self.which, none)
        return which[np.where(known, at, len(self.which))], row

    def vocabulary(self, toxic: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For words and n-grams: numbers from 1 of the buckets that enough texts have, 0 for
        the others, and by number how much commoner toxic texts make them (`_evidence`)."""
        row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        numbers, evidence = [], []
        for of_word, buckets, size in ((np.arange(len(self.word)), self.word, WORDS), (self.gram_of, self.gram, GRAMS)):
            # Texts by bucket, each once: all places of a word have the buckets of that word.
            pairs = np.unique(self.which * len(self.rows) + row)
            word, text_of = np.divmod(pairs, len(self.rows))
            order = np.argsort(of_word, kind="stable")
            many = np.bincount(of_word, minlength=len(self.word))
            begins = np.cumsum(many) - many
            own = order[np.repeat(begins[word] - np.cumsum(many[word]) + many[word], many[word]) + np.arange(many[word].sum())]
            seen = np.unique(buckets[own] * len(self.rows) + np.repeat(text_of, many[word]))
            bucket, text_of = np.divmod(seen, len(self.rows))
            texts = np.bincount(bucket, minlength=size)
            bad = np.bincount(bucket, toxic[text_of], minlength=size)
            often = np.flatnonzero(texts >= LEAST_TEXTS)
            found = np.zeros(size, np.int32)
            found[often] = np.arange(1, len(often) + 1)
            numbers.append(found)
            evidence.append(_evidence(bad[often], texts[often] - bad[often], toxic.sum(), (1 - toxic).sum()))
        return numbers, evidence


def _evidence(bad: np.ndarray, others: np.ndarray, all_bad: float, all_others: float) -> np.ndarray:
    """Logarithms of odds in units of their error, as far as they go beyond chance, times `EVIDENCE`."""
    odds = np.log((bad + 0.5) / (all_bad + 1)) - np.log((others + 0.5) / (all_others + 1))
    units = odds / np.sqrt(1 / (bad + 0.5) + 1 / (others + 0.5))
    return (np.sign(units) * np.clip(np.abs(units) - CHANCE, 0, CERTAIN) * EVIDENCE / CERTAIN).astype(np.float32)


def _inputs(params: Params, word: np.ndarray, gram: np.ndarray, gram_of: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The input of each distinct word, and zeros for a place without one."""
    out = np.zeros((len(word) + 1, INPUT), np.float32)
    chars = _sum_by(params["gram"][gram], gram_of, len(word))
    out[:-1] = params["word"][word] + chars / np.maximum(grams, 1)[:, None].astype(np.float32)
    return out


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of marked words, and the word of each."""
    lengths = ends - starts + 2
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    marked = np.empty(bounds[-1], np.uint8)
    inside = np.ones(bounds[-1], bool)
    inside[bounds[:-1]] = inside[bounds[1:] - 1] = False
    marked[bounds[:-1]], marked[bounds[1:] - 1] = ord("<"), ord(">")
    source = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - starts + 1, lengths)
    marked[inside] = data[source[inside]]
    buckets, words = [], []
    for size in GRAM_SIZES:
        counts = np.maximum(lengths - size + 1, 1)
        word = np.repeat(np.arange(len(starts)), counts)
        begin = bounds[:-1][word] + np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        end = np.minimum(begin + size, bounds[1:][word])
        buckets.append((text.hash_spans(marked, begin, end) % np.uint64(GRAMS)).astype(np.int64))
        words.append(word)
    return np.concatenate(buckets), np.concatenate(words)


def _sum_by(values: np.ndarray, group: np.ndarray, count: int) -> np.ndarray:
    return np.stack(
        [np.bincount(group, values[:, i], minlength=count) for i in range(values.shape[1])], axis=1
    ).astype(np.float32)


def fresh(words: int, grams: int, seed: int = 0) -> Params:
    """Embedding 0 is that of everything unknown and stays zero."""
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return draw.normal(0, scale, shape).astype(np.float32)

    return {
        "word": np.zeros((words + 1, INPUT), np.float32),
        "gram": np.concatenate([np.zeros((1, INPUT), np.float32), normal(grams, INPUT, scale=0.05)]),
        "enter": normal(INPUT, 6 * HIDDEN, scale=0.4),
        "enter_bias": np.zeros(6 * HIDDEN, np.float32),
        "stay": normal(2, HIDDEN, 3 * HIDDEN, scale=0.3),
        "look": normal(2 * HIDDEN, ATTENTION, scale=0.4),
        "attend": normal(ATTENTION, scale=0.4),
        "out": normal(2 * HIDDEN, scale=0.4),
        "out_bias": np.full(1, -2.0, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(params: Params, entered: np.ndarray, known: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows. ``entered``: (window, place, 6 * hidden); ``known``: places with words."""
    count = len(entered)
    both = np.stack([entered[..., : 3 * HIDDEN], entered[:, ::-1, 3 * HIDDEN :]])
    state = np.zeros((2, count, HIDDEN), np.float32)
    states = np.empty((WINDOW, 2, count, HIDDEN), np.float32)
    for t in range(WINDOW):
        x, passed = both[:, :, t], state @ params["stay"]
        gates = _sigmoid(x[..., : 2 * HIDDEN] + passed[..., : 2 * HIDDEN])
        update, reset = gates[..., :HIDDEN], gates[..., HIDDEN:]
        fresh_state = np.tanh(x[..., 2 * HIDDEN :] + reset * passed[..., 2 * HIDDEN :])
        if keep is not None:
            keep.append((state, update, reset, passed[..., 2 * HIDDEN :], fresh_state))
        state = fresh_state + update * (state - fresh_state)
        states[t] = state
    seen = np.concatenate([states[:, 0], states[::-1, 1]], axis=2).transpose(1, 0, 2)
    looked = np.tanh(seen @ params["look"])
    weight = np.where(known, looked @ params["attend"], -1e9)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = (weight[..., None] * seen).sum(axis=1)
    if keep is not None:
        keep.append((seen, looked, weight, pooled))
    return pooled @ params["out"] + params["out_bias"][0]


def backward(params: Params, keep: list, slope: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients from those of the logits, and those of ``entered``."""
    seen, looked, weight, pooled = keep.pop()
    grads: Params = {"out": pooled.T @ slope, "out_bias": slope.sum(keepdims=True)}
    to_pooled = slope[:, None] * params["out"]
    to_weight = (seen * to_pooled[:, None]).sum(axis=2)
    to_score = weight * (to_weight - (weight * to_weight).sum(axis=1, keepdims=True))
    grads["attend"] = np.einsum("bt,btk->k", to_score, looked)
    to_look = to_score[..., None] * params["attend"] * (1 - looked**2)
    grads["look"] = np.einsum("bth,btk->hk", seen, to_look)
    to_seen = weight[..., None] * to_pooled[:, None] + to_look @ params["look"].T
    to_states = to_seen.transpose(1, 0, 2)
    to_states = np.stack([to_states[..., :HIDDEN], to_states[::-1, :, HIDDEN:]], axis=1)
    to_entered = np.empty((2, len(slope), WINDOW, 3 * HIDDEN), np.float32)
    grads["stay"] = np.zeros_like(params["stay"])
    turned = params["stay"].transpose(0, 2, 1)
    to_state = np.zeros((2, len(slope), HIDDEN), np.float32)
    for t in range(WINDOW - 1, -1, -1):
        state, update, reset, passed, fresh_state = keep.pop()
        to_state = to_state + to_states[t]
        to_update = to_state * (state - fresh_state) * update * (1 - update)
        to_fresh = to_state * (1 - update) * (1 - fresh_state**2)
        to_reset = to_fresh * passed * reset * (1 - reset)
        to_entered[:, :, t] = np.concatenate([to_update, to_reset, to_fresh], axis=2)
        to_passed = np.concatenate([to_update, to_reset, to_fresh * reset], axis=2)
        grads["stay"] += state.transpose(0, 2, 1) @ to_passed
        to_state = to_state * update + to_passed @ turned
    return grads, np.concatenate([to_entered[0], to_entered[1, :, ::-1]], axis=2)


def train(texts: list[str], toxic: list[int], steps: int = STEPS, seed: int = 0) -> Params:
    """A model of which texts are toxic. A toxic text needs one toxic window, others none."""
    words = Words(pa.array(texts, pa.string()))
    labels = np.asarray(toxic, np.float32)
    (word_of_bucket, gram_of_bucket), evidence = words.vocabulary(labels)
    params = fresh(len(evidence[0]), len(evidence[1]), seed)
    # What a word or an n-gram says by itself is where its embedding starts.
    params["word"][1:, 0], params["gram"][1:, 1] = evidence
    known = {"word_of_bucket": word_of_bucket, "gram_of_bucket": gram_of_bucket}
    word, gram, gram_of = words.embedded(known)
    by_word = np.argsort(gram_of, kind="stable")
    gram, counts = gram[by_word], np.bincount(gram_of, minlength=len(word))
    begins = np.cumsum(counts) - counts
    windows, row = words.windows(WINDOW)
    by_row = np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1) if len(row) else []
    draw = np.random.default_rng(seed)
    slower = min(1.0, float(labels.sum()) / FEW)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    while step < steps and by_row:
        order = draw.permutation(len(by_row))
        for first in range(0, len(order), TEXTS_PER_STEP):
            if step == steps:
                break
            chosen = [by_row[i] for i in order[first : first + TEXTS_PER_STEP]]
            at = np.concatenate(chosen)
            here, inside = np.unique(windows[at], return_inverse=True)
            inside = inside.reshape(len(at), WINDOW)
            here = here[here < len(word)]
            many = counts[here]
            own_of = np.repeat(np.arange(len(here)), many)
            own = gram[np.arange(many.sum()) + np.repeat(begins[here] - (np.cumsum(many) - many), many)]
            each = np.maximum(words.grams[here], 1).astype(np.float32)
            # Some words are read by their characters alone, as words never seen will be.
            named = np.where(draw.random(len(here)) < DROPPED, 0, word[here])
            inputs = _inputs(params, named, own, own_of, each)
            entered = (inputs @ params["enter"] + params["enter_bias"])[inside]
            keep: list = []
            logits = forward(params, entered, inside < len(here), keep)
            slope = _slopes(logits, labels[row[at]], [len(c) for c in chosen])
            grads, to_entered = backward(params, keep, slope / len(chosen))
            flat = to_entered.reshape(-1, 6 * HIDDEN)
            grads["enter"] = inputs[inside.ravel()].T @ flat
            grads["enter_bias"] = flat.sum(axis=0)
            to_words = _sum_by(flat @ params["enter"].T, inside.ravel(), len(here) + 1)[:-1]
            grads["word"] = _sum_by(to_words, named, len(params["word"]))
            grads["gram"] = _sum_by((to_words / each[:, None])[own_of], own, len(params["gram"]))
            grads["word"][0] = grads["gram"][0] = 0
            step += 1
            _adam(params, grads, moments, step, {"word": slower, "gram": slower})
    params |= known
    return params


def _slopes(logits: np.ndarray, labels: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Slopes of the log loss: at a toxic text's highest window, at every window of others."""
    slope = _sigmoid(logits) - labels
    at = 0
    for size in sizes:
        if labels[at]:
            best = at + int(np.argmax(logits[at : at + size]))
            only = slope[best]
            slope[at : at + size] = 0
            slope[best] = only
        else:
            slope[at : at + size] /= np.sqrt(size)
        at += size
    return slope.astype(np.float32)


def _adam(params: Params, grads: Params, moments: dict, step: int, slower: dict[str, float]) -> None:
    for name, grad in grads.items():
        mean, square = moments[name]
        mean += 0.1 * (grad - mean)
        square += 0.001 * (grad * grad - square)
        rate = slower.get(name, 1.0) * RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        params[name] -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)


def scores(params: Params, column: pa.Array) -> np.ndarray:
    """The score of each text, 0 for one without words."""
    words = Words(column)
    windows, row = words.windows(STRIDE)
    out = np.zeros(len(column))
    if not len(row):
        return out
    entered = _inputs(params, *words.embedded(params), words.grams) @ params["enter"] + params["enter_bias"]
    logits = np.empty(len(row), np.float32)
    for first in range(0, len(row), _WINDOWS_AT_ONCE):
        part = windows[first : first + _WINDOWS_AT_ONCE]
        logits[first : first + len(part)] = forward(params, entered[part], part != len(words.word))
    np.maximum.at(out, row, _sigmoid(logits.astype(np.float64)))
    return out


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS, seed: int = 0
) -> Params:
    """Train on the labelled texts of smallest hash, of each label at most so many.

    Held-out rows, null labels and ids, and texts that are null, empty or over `FIT_BYTES`
    bytes are not learned from. Without labels the model is untrained.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    size = F.octet_length("text")
    texts = docs.where((size > 0) & (size <= FIT_BYTES)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Four times as many ids as rows wanted: over half of the texts are short enough.
    rank = F.xxhash64(F.lit(seed), "doc_id")
    chosen = [
        known.where(f"toxic = {label}").orderBy(rank, "doc_id").limit(4 * rows)
        for label, rows in ((1, toxic_rows), (0, other_rows))
    ]
    some = scratch.store(texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id"))
    rows = []
    for label, limit in ((1, toxic_rows), (0, other_rows)):
        rows += some.where(f"toxic = {label}").orderBy(rank, "doc_id", "text").limit(limit).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    params = train([r.text for r in rows], [r.toxic for r in rows], seed=seed)
    # Toxic texts are commoner in the sample than among the labels: shift the odds back.
    in_all = dict(known.where("toxic in (0, 1)").groupBy("toxic").count().collect())
    in_sample = [sum(r.toxic == label for r in rows) for label in (0, 1)]
    if all(in_sample) and all(in_all.get(label) for label in (0, 1)):
        params["out_bias"] += np.float32(np.log(in_all[1] / in_all[0]) - np.log(in_sample[1] / in_sample[0]))
    return params


def score(docs: DataFrame, params: Params, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, score, predicted.

    Null, empty and blank texts score 0. Equal texts score the same up to rounding.
    Repeated rows stay, null ids are not held out. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(params)

    def run(batches: Batches) -> Batches:
        for batch in text.slices(batches, limit=SLICE_BYTES):
            found = scores(held.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
