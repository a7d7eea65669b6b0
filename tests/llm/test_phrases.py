"""Phrase mining against a plain count of everything."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from doselake.llm import phrases


def _counts(rows, longest):
    counts, totals = defaultdict(Counter), Counter()
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    return counts, totals


def _best(rows, support, best, longest=4, covered=80):
    counts, totals = _counts(rows, longest)
    out = []
    for lang, own in counts.items():
        many = {p: f for p, f in own.items() if len(p) > 1 and f >= support}
        longer = Counter()
        for p, f in many.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], f)
        found = []
        for p, a in many.items():
            if 100 * longer[p] >= covered * a:
                continue
            cuts = [(2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def _rows(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["É", "Ab", "it's", "ß"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["new york city hall", "Ab w3 w3 Ab", "as well as", "w1 w1 w1 w1 w1"]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += draw.choices([*words, draw.choice(fixed)], [*weights, 0.5])[0]
            text += draw.choices([" ", "\t ", ". ", ",", "\n", "!", "\x0b", " "], [30, 2, 1, 1, 1, 1, 1, 1])[0]
        rows.append((draw.choice(["en", "de", None, "und"]) if i % 3 else "en", text))
    return [*rows, ("en", None), ("xx", " . "), ("en", "")]


@pytest.mark.parametrize(("parts", "at_once"), [(1, 10**6), (7, 10**6), (5, 150)])
def test_against_plain_counts(ready, texts, parts, at_once, monkeypatch):
    monkeypatch.setattr(phrases, "WORDS_AT_ONCE", at_once)
    docs = ready.createDataFrame(texts, "lang string, text string").repartition(parts)
    assert _rows(phrases.collocations(docs, support=12, best=25)) == _best(texts, 12, 25)


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_other_lengths(ready, texts, longest):
    docs = ready.createDataFrame(texts, "lang string, text string").repartition(3)
    want = _best(texts, 9, 1000, longest, covered=60)
    assert _rows(phrases.collocations(docs, support=9, longest=longest, best=1000, covered=60)) == want


def test_shards_prune_and_lose_nothing(ready, texts, monkeypatch):
    """All frequent phrases are among those mined, and far from all phrases are."""
    docs = ready.createDataFrame(texts, "lang string, text string").repartition(3)
    found, totals = phrases.candidates(docs, support=20)
    counts, sizes = _counts(texts, 4)
    want = {(lang, " ".join(p)): f for lang, own in counts.items() for p, f in own.items() if f >= 20}
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == want
    assert {r.lang: r.n for r in totals.collect()} == {k: n for k, n in sizes.items() if n}
    every = sum(len(own) for own in counts.values())
    rows = docs.na.fill({"lang": "und", "text": ""}).select("lang", "text")
    words, by_shard = phrases.word_counts(rows, 20)
    mined = phrases.mine(rows, by_shard, [2], phrases._table(words), 1, 20).count()
    assert mined < every / 10


def test_packed_counts():
    draw = random.Random(4)
    for size in (1, 2, 1000):
        hashes = np.array(sorted(draw.sample(range(1 << 40), size)), np.uint64)
        counts = np.array([draw.choice([1, 2, 300, 1 << 31]) for _ in range(size)])
        back = phrases._unpacked(phrases._packed(hashes, counts), size)
        assert back[0].tolist() == hashes.tolist() and back[1].tolist() == counts.tolist()
        bounds = phrases._ranges(hashes, 7)
        assert bounds[0] == 0 and bounds[-1] == size and (np.diff(bounds) >= 0).all()


def test_odd(ready, odd, empty):
    renamed = odd.withColumnRenamed("source", "lang")
    rows = [tuple(r) for r in renamed.select("lang", "text").collect()]
    assert _rows(phrases.collocations(renamed, support=2, best=50)) == _best(rows, 2, 50)
    assert phrases.collocations(empty.withColumnRenamed("source", "lang")).count() == 0
    blank = ready.createDataFrame([("en", " "), (None, None)], "lang string, text string")
    assert phrases.collocations(blank, support=1).count() == 0
