"""Chat folding and rendering by hand, and the toxicity network's gradients."""

from __future__ import annotations

import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from doselake.llm import chat, queries, toxicity

LOG = "conv_id long, turn long, nth long, seq long, kind string, role string, text string"


def test_render_is_reversible():
    draw = random.Random(1)
    parts = ["\\", "###", "</turn>", "### ", "\n", ":", "a", "<", "/turn>", "# Assistant:", "é"]
    for _ in range(3000):
        said = [("".join(draw.choices(parts, k=3)), "".join(draw.choices(parts, k=draw.randint(0, 9)))) for _ in range(3)]
        assert chat.parse("".join(chat.render(*s)[0] for s in said)) == said


def test_events_fold(ready):
    log = ready.createDataFrame(
        [
            (1, 0, 1, 0, "delta", "user", "he"), (1, 0, 1, 1, "delta", "user", "llo"),
            (1, 1, 1, 2, "delta", "assistant", "bad"), (1, 2, 1, 3, "delta", "user", "dropped"),
            (1, 1, 1, 4, "regenerate", "assistant", "go"), (1, 1, 1, 5, "delta", "assistant", "od"),
            (1, 2, 1, 6, "delta", "user", "thanks"), (1, 0, 1, 7, "edit", "user", "hi"),
            (2, 0, 1, 0, "delta", None, None),
        ],
        LOG,
    )
    got = chat.messages(log).collect()
    first = "".join(r.rendered for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.begin))
    assert chat.parse(first) == [("user", "hi"), ("assistant", "good"), ("user", "thanks")]
    assert [first[r.loss_begin : r.loss_end] for r in got if r.loss] == ["good"]
    assert [chat.parse(r.rendered) for r in got if r.conv_id == 2] == [[("", "")]]
    assert chat.messages(log.limit(0)).count() == 0


def test_digests_read_back(ready):
    text = queries.CONTROL_TEXT
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text), (3, None, "assistant", None), (3, 1, "user", "x"), (3, 1, "user", "x")]
    frame = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.messages(chat.log_of(frame))).collect()}
    own = f"user\n{text}\nassistant\n{text}\n"
    assert got[-7].turns_sha256 == hashlib.sha256(own.encode()).hexdigest()
    assert (got[-7].loss_chars, got[-7].loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
    assert (got[3].n_turns, got[3].loss_chars) == (3, 0)


@pytest.mark.parametrize("turns", [[1] * 1000 + [2] * 9, [None, -5, -1, 0] * 5, [None, -(1 << 63), (1 << 63) - 1] * 300])
def test_turns_of_any_length_and_number(ready, turns):
    rows = [(conv, turn, ("user", "assistant")[k % 2], f"text {k}") for conv in (1, None) for k, turn in enumerate(turns)]
    frame = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = ready.createDataFrame([(-7, k, r, queries.CONTROL_TEXT) for k, r in enumerate(("user", "assistant"))], frame.schema)
    got = chat.digests(chat.messages(chat.log_of(frame.union(own)))).collect()
    with duckdb.connect() as db:
        db.register("conversations", frame.toArrow())
        wanted = db.execute(queries.ORACLE_SQL["op3_chat_formatting"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_gradients_are_slopes():
    params = toxicity.fresh(3, 3, seed=1)
    draw = np.random.default_rng(0)
    entered = draw.normal(size=(2, toxicity.WINDOW, 6 * toxicity.HIDDEN))
    known = np.ones((2, toxicity.WINDOW), bool)
    keep: list = []
    toxicity.forward(params, entered, known, keep)
    grads, to_entered = toxicity.backward(params, keep, np.ones(2, np.float32))

    def total() -> float:
        return float(toxicity.forward(params, entered, known).sum())

    for name in ("stay", "look", "attend", "out"):
        flat = params[name].reshape(-1)
        for at in range(0, flat.size, max(1, flat.size // 5)):
            old = flat[at]
            flat[at] = old + 1e-2
            high = total()
            flat[at] = old - 1e-2
            low = total()
            flat[at] = old
            assert abs((high - low) / 2e-2 - grads[name].reshape(-1)[at]) < 1e-2
    assert np.isfinite(to_entered).all()


def test_odd_scores(ready, odd, empty):
    params = toxicity.fresh(1, 1)
    params["word_of_bucket"] = np.zeros(toxicity.WORDS, np.int32)
    params["gram_of_bucket"] = np.zeros(toxicity.GRAMS, np.int32)
    rows = toxicity.score(odd, params).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.predicted == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.score(empty, params).count() == 0


def test_half_a_window_lies_whole_in_one():
    words = toxicity.Words(pa.array([" ".join(f"w{k}" for k in range(size)) for size in range(1, 150)]))
    windows, row = words.windows(toxicity.STRIDE)
    half = toxicity.WINDOW // 2
    for nth, (start, end) in enumerate(itertools.pairwise(words.rows)):
        here = [bytes(w) for w in windows[row == nth]]
        for at in range(start, max(end - half, start) + 1):
            run = bytes(words.which[at : min(at + half, end)])
            assert any(run in w for w in here), (end - start, at - start)


def _marked(ready, name):
    docs, labels = (ready.read.parquet(f"/root/testdata/{name}/{t}.parquet") for t in ("documents", "labels"))
    params = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, params).where("held_out").join(labels.where("toxic is not null"), "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    others = [r.predicted for r in rows if not r.toxic]
    return sum(toxic), len(toxic), sum(others), len(others)


def test_held_out_recall(ready):
    """As it is set: nine tenths of the toxic texts, though one in twenty labels has nothing to go by."""
    found, toxic, wrong, others = _marked(ready, "sf0.1")
    assert toxic > 100 and found >= 0.9 * toxic
    assert wrong <= 0.05 * others


def test_few_labels(ready):
    """Of 14 held-out texts 9 hold a word that the 37 fitted ones hold, too."""
    found, toxic, wrong, others = _marked(ready, "sf0.01")
    assert toxic == 14 and found >= 8 and wrong <= 0.1 * others


def _plain_scores(params, words, row_words):
    """One text's score with a loop for each window, place, gate and unit."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    inputs = toxicity._inputs(params, *words.embedded(params), words.grams).astype(float)
    hidden, best = toxicity.HIDDEN, 0.0
    starts = range(0, max(len(row_words) - toxicity.WINDOW, 0) + toxicity.STRIDE, toxicity.STRIDE)
    for start in starts:
        window = row_words[start : start + toxicity.WINDOW]
        if not len(window):
            continue
        places = [*window, *[len(words.word)] * (toxicity.WINDOW - len(window))]
        entered = [inputs[w] @ params["enter"].astype(float) + params["enter_bias"] for w in places]
        states = [[None] * toxicity.WINDOW for _ in range(2)]
        for way in range(2):
            state = np.zeros(hidden)
            order = range(toxicity.WINDOW) if way == 0 else range(toxicity.WINDOW - 1, -1, -1)
            stay = params["stay"][way].astype(float)
            for t in order:
                x = entered[t][3 * hidden * way : 3 * hidden * (way + 1)]
                passed = [sum(state[i] * stay[i, j] for i in range(hidden)) for j in range(3 * hidden)]
                update = [sigmoid(x[j] + passed[j]) for j in range(hidden)]
                reset = [sigmoid(x[hidden + j] + passed[hidden + j]) for j in range(hidden)]
                fresh = [math.tanh(x[2 * hidden + j] + reset[j] * passed[2 * hidden + j]) for j in range(hidden)]
                state = np.array([update[j] * state[j] + (1 - update[j]) * fresh[j] for j in range(hidden)])
                states[way][t] = state
        seen = [np.concatenate([states[0][t], states[1][t]]) for t in range(len(window))]
        attention = [math.exp(float(np.tanh(h @ params["look"]) @ params["attend"])) for h in seen]
        pooled = sum(a / sum(attention) * h for a, h in zip(attention, seen, strict=True))
        best = max(best, sigmoid(float(pooled @ params["out"] + params["out_bias"][0])))
    return best


def test_scores_are_those_of_a_plain_loop():
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["you", "are", "Idiot", "fine", "d\u00e9j\u00e0", f"w{draw.randrange(30)}"]) for _ in range(n)) for n in (0, 1, 20, 32, 33, 70, 129)]
    params = toxicity.train([t for t in texts if t] * 4, [i % 2 for i in range(4 * 6)], steps=6)
    column = pa.array(texts)
    words = toxicity.Words(column)
    found = toxicity.scores(params, column)
    for i, (first, last) in enumerate(itertools.pairwise(words.rows)):
        assert found[i] == pytest.approx(_plain_scores(params, words, words.which[first:last]), abs=2e-4)
