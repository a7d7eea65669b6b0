"""Near-duplicates, mixing, shards, leaks, quality and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from doselake.llm import components, decontaminate, fingerprints, mixing, neardup, numbering, quality, sharding
from doselake.llm.text import WORD

from .conftest import SF_DIR


def _words(text):
    return re.findall(WORD, text or "")


def _lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _shingles(text, size):
    words = _words(_lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def _components(rows, size, similarity=80):
    sets = [(doc, _shingles(text, size)) for doc, text in rows]
    home = {doc: doc for doc, _ in rows}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, other in sets[:i]:
            both = len(one & other)
            if both and 100 * both >= similarity * len(one | other):
                low, high = sorted((find(a), find(b)))
                home[high] = low
    return {doc: find(doc) for doc, _ in rows}, {doc: len(s) for doc, s in sets}


@pytest.fixture(scope="module")
def chains(ready):
    """Groups of near-copies, chains of them, and unlike texts that share a passage."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(25)]
    rows = []
    for group in range(6):
        base = [word() for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(draw.randint(0, 9)):
                copy[draw.randrange(len(copy))] = word()
            if group % 2:
                base = copy
            rows.append(" ".join(copy))
    rows += [" ".join([*passage, *(word() for _ in range(draw.randint(5, 60)))]) for _ in range(150)]
    draw.shuffle(rows)
    return ready.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize(("size", "cell"), [(4, 3)])
def test_near_duplicates(chains, size, cell, monkeypatch):
    monkeypatch.setattr(neardup, "CELL", cell)
    want, sizes = _components(chains.collect(), size)
    got = neardup.near_duplicates(chains, words=size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(want.values())) < len(want) - 50


def test_near_duplicates_of_documents(documents):
    want, _ = _components(documents.select("doc_id", "text").collect(), 5)
    got = neardup.near_duplicates(documents).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_odd_near_duplicates(odd, empty):
    got = neardup.near_duplicates(odd, words=4).collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.component_id for r in by[1]] == [1, 1] and by[2][0].component_id == 1
    assert [(r.n_shingles, r.kept) for i in (3, 4, 5) for r in by[i]] == [(0, True)] * 3
    assert by[7][0].component_id == by[11][0].component_id == 6
    assert by[9][0].component_id == 8
    assert sorted(str(r.component_id) for r in by[None]) == ["1", "None", "None"]
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.keep_one(odd, words=4)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 8, 10, -5, None, None])
    assert neardup.keep_one(empty).count() == 0


def test_components(ready):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(draw.randint(100, 400), draw.randint(100, 400)) for _ in range(200)]
    home = {}

    def find(x):
        home.setdefault(x, x)
        while home[x] != x:
            x = home[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        home[high] = low
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    frame = ready.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")
    assert {r.node: r.component for r in components.components(frame).collect()} == want
    assert components.components(frame.limit(0)).count() == 0


def test_components_store_each_round_once(ready, monkeypatch):
    """A star needs its edges and one round, and no further round to see that it is done."""
    stored = []
    store = components.scratch.store
    monkeypatch.setattr(components.scratch, "store", lambda df: stored.append(df) or store(df))
    star = ready.createDataFrame([(50, i) for i in range(30, 70)], "a long, b long")
    got = components.components(star).collect()
    assert {r.node: r.component for r in got} == dict.fromkeys(range(30, 70), 30)
    assert len(stored) == 2
    assert components.components(ready.createDataFrame([(9, 2), (2, 7), (9, 2)], "a long, b long")).count() == 3
    assert len(stored) == 3  # these are stars as they are


def test_merged_components(ready):
    homes = ready.createDataFrame([(1, 1), (2, 1), (5, 4), (4, 4), (9, 8), (8, 8)], "node long, component long")
    more = ready.createDataFrame([(5, 9), (20, 2), (30, 31), (9, 4)], "a long, b long")
    got = neardup._merged(homes, more).collect()
    assert {r.node: r.component for r in got} == {1: 1, 2: 1, 20: 1, 4: 4, 5: 4, 8: 4, 9: 4, 30: 30, 31: 30}
    assert len(got) == 9


def test_other_leaders_are_of_other_components(ready):
    """One shuffle for the lists, one for their rows, one by node and one to drop repeats."""
    homes = {n: n // 10 for n in range(60)} | {n: n for n in range(60, 80)}
    rows = ready.createDataFrame(
        [(key, n, home) for n, home in homes.items() for key in {n % 7, 100 + n % 3}], "key long, node long, home long"
    )
    tried = neardup._other_leaders(rows, range(1, 4))
    plan = tried._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 4
    pairs = [(r.a, r.b) for r in tried.collect()]
    assert len(pairs) == len(set(pairs)) and {b for _, b in pairs} == set(homes)
    assert all(homes[a] != homes[b] for a, b in pairs)
    assert all({a % 7} & {b % 7} or {a % 3} & {b % 3} for a, b in pairs)
    assert len(pairs) > len(homes)  # more than one leader a node


def test_bins_in_columns_as_in_arrays(ready):
    rng = np.random.default_rng(5)
    left = rng.integers(0, 256, (60, neardup.BINS), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < rng.random((60, 1)), rng.integers(0, 256, left.shape), left)
    empty = rng.random(left.shape) < rng.random((60, 1))
    left, right = np.where(empty, 0, left).astype(np.uint8), np.where(empty, 0, right).astype(np.uint8)
    want = neardup._alike(left, right, 80).tolist()
    rows = [(i, a.view(np.int64).tolist(), b.view(np.int64).tolist()) for i, (a, b) in enumerate(zip(left, right, strict=True))]
    frame = ready.createDataFrame(rows, "i long, l array<long>, r array<long>")
    got = frame.select("i", neardup._may_be_alike("l", "r", 80).alias("alike")).sort("i").collect()
    assert [r.alike for r in got] == want and 0 < sum(want) < 60


def test_mix_by_definition(ready):
    draw = random.Random(4)
    rows = [(i, draw.choice("abcde") if i % 9 else None, " w" * draw.choice([1, 3, 50])) for i in range(900)]
    docs = ready.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs).collect()
    total = sum(r["size"] for r in got)
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken <= 3 * r["size"] and r.taken % r["size"] == 0
    assert sum(target.values()) == pytest.approx(total)
    assert all(target[s] <= 3 * size[s] for s in size)
    assert all(abs(taken[s] - target[s]) <= 25.001 for s in size)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_follows_preferences(ready):
    rows = [(i, "a", " w" * 10, 1.0 if i % 2 else 3.0) for i in range(1000)]
    rows += [(i, "b", " w" * 10, 1.0) for i in range(1000, 5000)]
    docs = ready.createDataFrame(rows, "doc_id long, source string, text string, liked double")
    weights = ready.createDataFrame([("a", 1), ("b", 9)], "source string, weight long")
    got = mixing.mix(docs, weights=weights, share=0.1, preference="liked").where("source = 'a'").collect()
    liked = sum(r.taken for r in got if r.doc_id % 2 == 0)
    assert sum(r.taken for r in got) == pytest.approx(500, abs=10)
    assert 0.6 < liked / 500 < 0.9


def test_maps_and_dotted_names_pass(ready):
    rows = [(1, "a b c d e f", "s", {"k": 1}, 2), (1, "a b c d e f", "s", {"k": 1}, 2), (None, "a b c d e f", "t", None, 3)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, `a.b` int")
    assert neardup.keep_one(docs, words=2).columns == docs.columns
    assert [r.doc_id for r in neardup.keep_one(docs, words=2).collect()] == [1]
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() >= 2
    bench = ready.createDataFrame([(1, "b c d e")], "item_id long, text string")
    assert decontaminate.clean(docs, bench).count() == 0


def test_odd_mix(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count()
    assert all(r.taken == 0 for r in got if r.doc_id in (3, 4, 5))
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    copies = Counter((r.doc_id, len(_words(r.text))) for r in mixed.collect())
    want = Counter()
    for r in got:
        want[(r.doc_id, r["size"])] += r.copies
    assert +want == copies
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_numbers_have_no_gaps(ready):
    rows = ready.range(5000).selectExpr("id % 3 as g", "id", "pmod(xxhash64(id), 40) as b")
    got = numbering.numbered(rows, ["g"], rows["b"], [rows["id"]], "n").collect()
    for g in range(3):
        assert sorted(r.n for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))
    keyed = ready.range(3000).selectExpr("id", "cast((id * 7919) % 500 - 250 as double) as k")
    first = numbering.first_by(keyed, "k", [keyed["id"]], 777, 4).where("first").collect()
    want = sorted((((i * 7919) % 500 - 250, i) for i in range(3000)))[:777]
    assert sorted((r.k, r.id) for r in first) == want


def _check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(documents):
    rows = sharding.shard(documents, shards=8).collect()
    texts = dict(documents.select("doc_id", "text").collect())
    _check_shards(rows, 8)
    homes, loads, groups = defaultdict(set), Counter(), Counter()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        homes[raw].add(r.shard)
        groups[raw] += r["size"]
        loads[r.shard] += r["size"]
    assert all(len(h) == 1 for h in homes.values())
    fair = sum(loads.values()) / 8
    assert max(loads.values()) <= max(fair * 1.0005 + 1, max(groups.values()))
    again = sharding.shard(documents.repartition(6), shards=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_a_group_above_a_shard_is_split(ready):
    rows = [(i, "same text in many places") for i in range(2000)] + [(i, f"text {i}") for i in range(2000, 4000)]
    got = sharding.shard(ready.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    _check_shards(got, 4)
    loads = Counter()
    for r in got:
        loads[r.shard] += r["size"]
    assert max(loads.values()) / min(loads.values()) < 1.01


def test_a_heavy_group_without_ids_is_split(ready):
    rows = [(None, "same text in many places")] * 2000 + [(i, f"text {i}") for i in range(2000, 4000)]
    got = sharding.shard(ready.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    _check_shards(got, 4)
    loads = Counter()
    for r in got:
        loads[r.shard] += r["size"]
    assert max(loads.values()) / min(loads.values()) < 1.01


def test_ring_by_plain_walk():
    """Every place against a walk over all virtual nodes in order."""
    draw = random.Random(9)
    for shards, slack in ((3, 0.01), (8, 0.3), (5, 10.0)):
        sizes = [draw.choice([1, 1, 1, 5, 40]) for _ in range(600)]
        capacity = sum(sizes) / shards * (1 + slack)
        ring, loads = sharding.Ring(shards, capacity, 16), [0] * shards
        for size in sizes:
            place = draw.randrange(-(1 << 63), 1 << 63)
            walk = sorted(ring.nodes, key=lambda node: ((node[0] - place) % (1 << 64), node[1]))
            home = next((s for _, s in walk if loads[s] + size <= capacity), None)
            if home is None:
                home = min(range(shards), key=lambda s: (loads[s], s))
            loads[home] += size
            assert ring.put(place, size) == home
        assert ring.load == loads


def test_a_new_shard_moves_little():
    places = [int.from_bytes(hashlib.md5(str(i).encode()).digest()[:8], "big", signed=True) for i in range(4000)]
    before, after = (sharding.Ring(n, 1.05 * len(places) / n) for n in (8, 9))
    moved = sum(before.put(p, 1) != after.put(p, 1) for p in places)
    assert moved < len(places) / 2
    assert max(before.load) <= 525 and max(after.load) <= 467


def test_odd_shards(odd, empty):
    rows = sharding.shard(odd, shards=3).collect()
    assert len(rows) == odd.count()
    _check_shards(rows, 3)
    assert sharding.shard(empty).count() == 0


def _sellers(item, window):
    row = [0] * (len(window) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(window, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_matches_by_brute_force(ready):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    items = [" ".join(word() for _ in range(draw.randint(3, 9))) for _ in range(6)]
    docs = []
    for i in range(90):
        item = list(draw.choice(items))
        for _ in range(draw.randint(0, 6)):
            at = draw.randrange(len(item))
            item[at : at + draw.randint(0, 1)] = [draw.choice("abcde \n")] * draw.randint(0, 2)
        around = [" ".join(word() for _ in range(draw.randint(0, 15))) for _ in range(2)]
        docs.append((i, f"{around[0]} {''.join(item).upper()}  {around[1]}" if i % 4 else around[0]))
    want = set()
    for i, text in docs:
        for j, item in enumerate(items):
            wanted = decontaminate.normalise(item)
            edits = _sellers(wanted, decontaminate.normalise(text))
            if edits <= int(len(wanted) * 0.2):
                want.add((i, j, edits))
    frame = ready.createDataFrame(docs, "doc_id long, text string")
    bench = ready.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.matches(frame, bench, error_rate=0.2).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == want
    assert any(e for _, _, e in want) and len(got) == len(want)
    texts = dict(docs)
    for r in got:
        found = decontaminate.normalise(texts[r.doc_id])[r.start : r.end]
        assert _sellers(decontaminate.normalise(items[r.item_id]), found) == r.edits


def test_leaks_in_documents(ready, documents):
    bench = ready.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [decontaminate.normalise(r.text) for r in bench.collect()]
    dirty = {
        r.doc_id for r in documents.collect() if any(i in decontaminate.normalise(r.text) for i in items)
    }
    clean = {r.doc_id for r in decontaminate.clean(documents, bench).collect()}
    assert dirty and not dirty & clean
    assert len(clean) >= documents.count() - len(dirty) - 2


def test_odd_leaks(ready, odd, empty):
    bench = ready.createDataFrame([(1, "c d e f g"), (None, "thing59999 end"), (2, None), (3, " ")], "item_id long, text string")
    got = decontaminate.matches(odd, bench).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter([(1, 1), (1, 1), (2, 1), (None, 1), (9, None)])
    kept = decontaminate.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 5
    assert decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.clean(odd, bench.limit(0)).count() == odd.count()


def test_blocks_find_the_same(ready, documents, monkeypatch):
    bench = ready.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = sorted(map(str, decontaminate.matches(documents, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    assert sorted(map(str, decontaminate.matches(documents, bench).collect())) == whole


def test_quality_rejects_junk_and_keeps_the_rest(ready):
    folder = "/root/testdata/sf0.01"
    docs, labels = (ready.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.kept for r in got if r.quality == 1)
    assert not any(r.kept for r in got if r.quality == 0)
    assert len({r.quality for r in got}) == 2


def test_quality_learns_from_part_of_the_labels(ready):
    folder = "/root/testdata/sf0.01"
    docs, labels = (ready.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learned = labels.where("doc_id % 2 = 0")
    got = quality.classify(docs, learned).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) >= 0.97 * len(got)


def _gumbel_shares(margins, take, rounds=400):
    """How often each class of margins is taken, drawn one after the other in proportion to weights."""
    draw = np.random.default_rng(5)
    weights = np.exp(margins - margins.max())
    hits = np.zeros(len(margins))
    for _ in range(rounds):
        hits[draw.choice(len(margins), take, replace=False, p=weights / weights.sum())] += 1
    return hits / rounds


def test_resampling_takes_in_proportion_to_weights(ready):
    classes = np.array([-2.0, 0.0, 1.0, 3.0])
    rows = ready.range(8000).selectExpr("id AS doc_id", "5L AS words", "element_at(array(-2D, 0D, 1D, 3D), int(id % 4) + 1) AS margin")
    want = _gumbel_shares(np.repeat(classes, 20), 30).reshape(4, 20).mean(axis=1)
    taken = []
    for seed in (1, 2):
        got = quality.resample(rows, 3000, seed=seed).where("kept").collect()
        assert len(got) == 3000
        shares = [sum(r.margin == c for r in got) / 2000 for c in classes]
        assert np.allclose(shares, want, atol=0.03), (shares, want)
        taken.append({r.doc_id for r in got})
    assert 0.2 < len(taken[0] & taken[1]) / 3000 < 0.95  # the noise decides
    cold = quality.resample(rows, 3000, temperature=0.0).where("kept").collect()
    assert sum(r.margin == 3.0 for r in cold) == 2000


def test_as_many_are_taken_as_asked_for(ready, documents):
    labels = ready.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.classify(documents, labels, take=50).collect()
    kept = sorted((r.noisy for r in got if r.kept), reverse=True)
    assert len(kept) == 50 and kept[-1] >= max(r.noisy for r in got if not r.kept)


def test_weights_by_brute_force(ready, documents):
    """Sums, ratios and odds by plain counting of the n-grams of one text at a time."""
    import pyarrow as pa

    labels = {r.doc_id: r.quality for r in ready.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    grams = {d: quality._ngrams(pa.record_batch({"text": pa.array([t], pa.string())}))[0] for d, t in texts.items()}
    raw, target = ([Counter() for _ in range(quality.FAMILIES)] for _ in range(2))
    for d, own in grams.items():
        for family in range(quality.FAMILIES):
            raw[family].update(own[family].tolist())
            if labels.get(d) == 1:
                target[family].update(own[family].tolist())
    ratio = []
    for t, r in zip(target, raw, strict=True):
        ts, rs = sum(t.values()) + quality.BUCKETS, sum(r.values()) + quality.BUCKETS
        ratio.append([math.log((t[b] + 1) / ts) - math.log((r[b] + 1) / rs) for b in range(quality.BUCKETS)])
    weight = {d: sum(ratio[f][b] for f in range(quality.FAMILIES) for b in own[f].tolist()) for d, own in grams.items()}
    got = quality.classify(documents, ready.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    for r in got:
        assert r.words == len(_words(texts[r.doc_id]))
        assert r.log_weight == pytest.approx(weight[r.doc_id], abs=1e-6)
    filled = [r for r in got if r.words]
    centres = {round((r.log_weight - r.margin) / r.words, 9) for r in filled}
    assert len(centres) == 1
    expected = round(sum(1 / (1 + math.exp(-max(r.margin, -700))) for r in filled))
    best = sorted(filled, key=lambda r: -r.noisy)[:expected]
    assert {r.doc_id for r in filled if r.kept} == {r.doc_id for r in best}


def test_ngram_counts_are_sums(ready, documents):
    whole = quality.ngram_counts(documents.coalesce(1))
    assert (whole == quality.ngram_counts(documents.repartition(5))).all()
    words = sum(len(_words(r.text)) for r in documents.collect())
    assert whole.sum(axis=1).tolist() == [words] * quality.FAMILIES


def test_odd_quality(ready, odd, empty):
    labels = ready.createDataFrame(
        [(1, 1), (1, 1), (8, 0), (9, 0), (6, None), (None, 1), (99, 1)], "doc_id long, quality int"
    )
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count()
    assert all(r.log_weight == 0 and r.kept for r in got if r.doc_id in (3, 4, 5))
    assert {r.doc_id for r in got if not r.kept} >= {8, 9}
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns and 1 in {r.doc_id for r in kept.collect()}
    assert all(r.kept for r in quality.classify(odd, labels.limit(0)).collect())
    assert quality.classify(empty, labels).count() == 0


def _entropies(data):
    out = []
    for i in range(len(data) - 63):
        counts = Counter(data[i : i + 64])
        out.append(-sum(c / 64 * np.log2(c / 64) for c in counts.values()))
    return out


def test_levels_are_entropies():
    draw = random.Random(6)
    rows = [bytes(draw.choice(b"abcde fgh\xc3") for _ in range(n)) for n in (200, 10, 64, 0, 90)]
    data = np.frombuffer(b"".join(rows), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    levels = fingerprints._levels(data, offsets)
    at = 0
    for row in rows:
        want = _entropies(row)
        got = levels[at : at + len(row)]
        assert (got[len(want) :] == -1).all()
        assert np.allclose(got[: len(want)], np.array(want) / 6 * 1000, atol=1.01)
        at += len(row)


def _chosen(levels, ranks):
    """Windows with votes, run by run."""
    rank = [ranks[v] if v >= 0 else -1 for v in levels]
    votes = Counter()
    for first in range(-63, len(rank)):
        run = [(rank[i], i) for i in range(max(first, 0), min(first + 64, len(rank))) if rank[i] >= 0]
        if run:
            votes[min(run)[1]] += 1
    return [i for i in range(len(rank)) if votes[i] >= fingerprints.POPULAR]


def test_features_by_brute_force(monkeypatch):
    draw = random.Random(7)
    ranks = fingerprints.rarity(np.array([draw.randint(0, 9999) for _ in range(fingerprints.LEVELS)]))
    rows = [bytes(draw.choice(b"abcdefgh ijklmno") for _ in range(n)) for n in (500, 70, 30, 64, 900)]
    data = np.frombuffer(b"".join(rows), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    found, hashes = fingerprints._features(data, offsets, ranks)
    for i, row in enumerate(rows):
        own = np.frombuffer(row, np.uint8)
        want = _chosen(fingerprints._levels(own, np.array([0, len(row)])), ranks)
        assert (found == i).sum() == len(want)
        if want:
            expected = [fingerprints.text.hash_spans(own, np.array([w]), np.array([w + 64]))[0] for w in want]
            assert hashes[found == i].tolist() == expected
    whole = fingerprints._features(data, np.array([0, len(data)]), ranks)[1].tolist()
    monkeypatch.setattr(fingerprints, "SLICE_BYTES", 200)
    assert fingerprints._features(data, np.array([0, len(data)]), ranks)[1].tolist() == whole


def test_fingerprints(documents):
    rows = {r.doc_id: r for r in fingerprints.fingerprints(documents).collect()}
    texts = sorted(documents.select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    same = defaultdict(set)
    for i, (doc, text) in enumerate(texts):
        text, following = text or "", texts[(i + 1) % len(texts)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = rows[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        own = fingerprints.decode(r.fingerprint)
        assert r.near_edited == fingerprints.likeness(own, fingerprints.decode(r.edited_fingerprint))
        assert r.near_next == fingerprints.likeness(own, fingerprints.decode(rows[texts[(i + 1) % len(texts)][0]].fingerprint))
        same[text].add(r.fingerprint)
    assert all(len(f) == 1 for f in same.values())
    large = [r for r in rows.values() if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in large]) > 0.5 > 0.2 > np.mean([r.near_next for r in large])


def test_odd_fingerprints(odd, empty, ready):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[3][0].n_chars == 0 and by[3][0].near_edited == 1.0
    assert by[1][0].fingerprint == by[1][1].fingerprint
    assert by[8][0].near_next > 0.9
    alone = fingerprints.fingerprints(ready.createDataFrame([(4, "abcd")], "doc_id long, text string")).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abca").hexdigest()
    assert fingerprints.fingerprints(empty).count() == 0
