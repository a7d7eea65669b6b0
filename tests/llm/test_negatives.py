"""Hard negatives against scoring every anchor with every row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from doselake.llm import negatives

from .conftest import SF_DIR

SCHEMA = "vec_id long, label int, embedding array<float>, row string, leaf int, `odd.name` map<string,int>"


def _mined(rows, every, positives, count, low=50, high=95, relabel=0):
    used = []
    for vec_id, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if relabel and vec_id is not None and vec_id % relabel == 0:
            label = (label + 1) % 10
        used.append((vec_id, label, [math.floor(256.0 * float(np.float32(x))) for x in vector]))
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, (anchor, label, vector) in enumerate(used):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(x * y for x, y in zip(vector, other, strict=False)), vec_id, own)
            for j, (vec_id, own, other) in enumerate(used) if j != i
        ]
        near = sorted((s for s in scored if s[2] == label), key=order)[:positives]
        far = sorted((s for s in scored if s[2] != label), key=order)
        for score, positive, _ in near:
            fit = [s for s in far if low * score <= 100 * s[0] <= high * score][:count]
            out += [(anchor, positive, rank, s[1], score, s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=str)


def _rows(df):
    return sorted(
        ((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()),
        key=str,
    )


def _frame(ready, rows):
    return ready.createDataFrame([(*r, "x", 7, {"k": 1}) for r in [(i, y, v) for i, y, v in rows]], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    """Clusters, many equal vectors, ties, and rows that take no part."""
    draw = random.Random(6)
    centres = [[draw.gauss(0, 0.4) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(700):
        centre = draw.choice(centres)
        rows.append((i, draw.randint(0, 3), [x + draw.gauss(0, 0.1) for x in centre]))
    rows += [(i, draw.randint(0, 3), centres[0]) for i in range(700, 1000)]
    rows += [(1000, None, centres[0]), (1001, 1, None), (1002, 1, [None] * 6), (1003, 1, [math.inf] * 6), (1004, 1, [math.nan] * 6)]
    return [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]


@pytest.mark.parametrize(("leaf_rows", "part_rows"), [(10, 10**6), (40, 16), (10**6, 64)])
def test_against_all_pairs(ready, vectors, leaf_rows, part_rows):
    found = negatives.hard_negatives(_frame(ready, vectors).repartition(3), 20, relabel_every=7, leaf_rows=leaf_rows, part_rows=part_rows)
    want = _mined(vectors, 20, 5, 3, relabel=7)
    assert _rows(found) == want and len(want) > 200


def test_embeddings(ready):
    table = ready.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "label", "embedding").collect()]
    found = negatives.hard_negatives(table, relabel_every=7, leaf_rows=20, part_rows=32)
    assert _rows(found) == _mined(rows, 50, 5, 3, relabel=7)


def test_siblings_are_eliminated(ready, vectors):
    """Narrow windows around clusters reach few leaves, and lose nothing."""
    rows = negatives.prepared(_frame(ready, vectors))
    index = negatives.build(rows, leaf_rows=30)
    known = index.shared.value
    held = rows.collect()
    points = np.array([r.vector for r in held])
    leaf = known.tree.route(points)[0]
    score = points @ points.T
    low = np.sort(score, axis=1)[:, -3].astype(float)
    high = np.full(len(points), 1e9)
    reached = np.zeros((len(points), known.tree.leaves), bool)
    for number, some in known.alive(points, low, high):
        reached[some, number] = True
    for i in range(len(points)):
        assert reached[i, leaf[score[i] >= low[i]]].all()
    assert known.tree.leaves > 8 and reached.mean() < 0.5


def test_scores_beyond_doubles():
    left, right = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**22, -1.0]])
    assert negatives.scores(left, right).tolist() == [[2**60 + 1, 2**62 - 1]]


def test_odd(ready):
    rows = [
        (0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (None, 1, [0.4, 0.5]), (None, 2, [0.3, 0.4]), (3, 2, [0.3, 0.4]),
        (4, 2, [0.6]), (5, 2, []), (6, 1, [-0.5, -0.5, 2.0]), (50, 2, [-1.0, 0.0]), (100, 3, [0.0, 0.0]), (-50, 2, [0.3, 0.3]),
    ]
    found = negatives.hard_negatives(_frame(ready, rows), leaf_rows=2)
    width = max(len(v) for _, _, v in rows)
    padded = [(i, y, [*v, *[0.0] * (width - len(v))]) for i, y, v in rows]
    assert _rows(found) == _mined(padded, 50, 5, 3)
    assert negatives.hard_negatives(_frame(ready, []).limit(0)).count() == 0
    assert negatives.hard_negatives(_frame(ready, [(1, 1, [0.5])])).count() == 0
