"""The corpus pipeline on a small table: every stage against brute force on what it was given."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from doselake.llm import decontaminate, mixing, scratch

from .conftest import SF_DIR
from .test_documents import _components, _words


@pytest.fixture(scope="module")
def stages(ready):
    """(name, rows before, rows after) of every stage, run as `run` does."""
    docs = ready.read.parquet(f"{SF_DIR}/documents.parquet")
    # Rows without an id, a shared id and repeated rows beside the given ones.
    extra = docs.limit(3).selectExpr("CAST(NULL AS long) AS doc_id", "text", "lang", "source", "n_chars")
    shared = docs.where("doc_id in (5, 6)").selectExpr("7L AS doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(extra).unionByName(shared).unionByName(docs.limit(2))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.store(stage(ready, docs, SF_DIR))
        out[name] = (docs.collect(), after.collect(), docs, after)
        docs = after
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["quality classifier", "near-duplicates", "benchmark decontamination", "mixing sources", "sharding"]
    for _, _, docs, after in list(stages.values())[:-1]:
        assert after.columns == docs.columns


def _bag(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_quality(ready, stages):
    before, after, docs, _ = stages["quality classifier"]
    labels = ready.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id: r.quality for r in labels.collect()}
    assert all((r.doc_id, r.text) in _bag(after) for r in before if good.get(r.doc_id) == 1 and r.doc_id != 7)
    assert not any(good.get(r.doc_id) == 0 and r.doc_id != 7 for r in after)
    assert not _bag(after) - _bag(before) and len(after) < len(before)
    # Rows go by their own texts: all rows of a text without a label stay, or none does.
    judged = {}
    for r in before:
        judged.setdefault((r.doc_id, r.text), set()).add((r.doc_id, r.text) in _bag(after))
    assert all(len(found) == 1 for found in judged.values())


def test_near_duplicates(stages):
    before, after, _, _ = stages["near-duplicates"]
    texts = list({(r.doc_id, r.text) for r in before})
    home, sizes = _components(list(enumerate(t for _, t in texts)), 5)
    groups = {}
    for i, (doc, text) in enumerate(texts):
        if sizes[i]:
            groups.setdefault(home[i], []).append((doc is None, doc if doc is not None else 0, text))
    want = Counter(r for r in _bag(before).elements() if not _words(r[1]))
    got = _bag(after)
    for held in groups.values():
        first = min(held)[:2]
        kept = [r for r in got if (r[0] is None, r[0] or 0, r[1]) in held]
        assert len(kept) == 1 and got[kept[0]] == 1 and (kept[0][0] is None, kept[0][0] or 0) == first
    assert sum(got.values()) == len(groups) + sum(want.values())


def test_decontamination(ready, stages):
    before, after, _, _ = stages["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in ready.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items, decontaminate.ERROR_RATE)
    wholes = [decontaminate.normalise(t) for _, t in items]
    clean = Counter()
    for r in before:
        dirty = bool(list(matcher.find(r.text)))
        assert dirty or not any(w and w in decontaminate.normalise(r.text) for w in wholes)
        clean[(r.doc_id, r.text)] += not dirty
    assert +clean == _bag(after) and len(after) < len(before)


def test_mix(stages):
    before, after, docs, _ = stages["mixing sources"]
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[(r.doc_id, r.source, r["size"])] += r.copies
    assert +copies == Counter((r.doc_id, r.source, len(_words(r.text))) for r in after)
    assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before}
    sizes = Counter()
    for r in before:
        sizes[r.source] += len(_words(r.text))
    targets = {r.source: r.target for r in mixing.mix(docs).collect()}
    longest = max(len(_words(r.text)) for r in before)
    taken = Counter()
    for r in after:
        taken[r.source] += len(_words(r.text))
    assert all(abs(taken[s] - targets[s]) <= longest for s in sizes)


def test_shards(stages):
    before, after, _, _ = stages["sharding"]
    assert len(after) == len(before)
    assert Counter((r.doc_id, r["size"]) for r in after) == Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in before)
    slots = {}
    for r in after:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_is_its_stages(ready, stages):
    docs = ready.read.parquet(f"{SF_DIR}/documents.parquet")
    want = docs
    for _, stage in corpus_pipeline.STAGES:
        want = scratch.store(stage(ready, want, SF_DIR))
    got = corpus_pipeline.run(ready, SF_DIR)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

