"""Vector best-fit packing against a packer that places one piece after the other."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from doselake.llm import packing
from doselake.llm.packing import Capacity


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def _ids(tokenizer, value):
    return [*tokenizer.encode(value or "", add_special_tokens=False).ids, 0]


def _one_by_one(lengths, capacity, weights, rule):
    """Sequences as lists of lengths, each piece put into the best one there is."""
    whole = capacity.vector()
    scale = np.sqrt(np.array(weights)) / whole
    bins = []  # (room, pieces)
    for length in sorted(lengths, reverse=True):
        item = np.array([length, 1, length * length])
        best = None
        for room, pieces in bins:
            if (room >= item).all():
                if rule == "norm":
                    value = -np.square((room - item) * scale).sum()
                else:
                    value = (room * scale * (item * scale)).sum()
                if best is None or value > best[0]:
                    best = (value, room, pieces)
        if best is None:
            bins.append((whole - item, [length]))
        else:
            best[1][:] -= item
            best[2].append(length)
    return Counter(_room(pieces) for _, pieces in bins)


def _room(pieces):
    """What tells sequences apart: those that hold as much take the next piece by turns."""
    return len(pieces), sum(pieces), sum(n * n for n in pieces)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [Capacity(64), Capacity(64, 4), Capacity(64, 64, 1500), Capacity(64, 5, 900)])
def test_plan_is_that_of_single_pieces(capacity, rule):
    draw = random.Random(f"{capacity}{rule}")
    weights = (1.0, 0.37, 0.11)
    for _ in range(12):
        lengths = [min(64, int(draw.expovariate(1 / 14)) + 1) for _ in range(draw.randint(1, 220))]
        made = packing.plan(Counter(lengths), capacity, weights, rule)
        nth, found = Counter(), defaultdict(list)
        for length in lengths:
            sequence, offset = made.place(np.array([length]), np.array([nth[length]]))
            nth[length] += 1
            found[int(sequence[0])].append((int(offset[0]), length))
        assert set(found) == set(range(made.sequences))
        for held in found.values():
            held.sort()
            ends = np.cumsum([n for _, n in held])
            assert [o for o, _ in held] == [0, *ends[:-1]] and ends[-1] <= 64
            if len(held) > 1:
                assert len(held) <= capacity.documents
                assert sum(n * n for _, n in held) <= capacity.vector()[2]
        assert Counter(_room([n for _, n in held]) for held in found.values()) == _one_by_one(
            lengths, capacity, weights, rule
        )


def test_unknown_rule():
    with pytest.raises(ValueError, match="unknown rule"):
        packing.plan({3: 1}, Capacity(), rule="first")


def _check(rows, tokenizer, docs, length):
    held, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    assert set(held) == set(range(len(held)))
    for pieces in held.values():
        pieces.sort()
        ends = np.cumsum([n for _, n in pieces])
        assert [o for o, _ in pieces] == [0, *ends[:-1]] and ends[-1] <= length
    want = defaultdict(Counter)
    for doc, value in docs:
        ids = _ids(tokenizer, value)
        first = len(ids) % length or length
        cuts = [0, *range(first, len(ids), length), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[doc][(piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = {d: Counter((r.piece, r.start, r.length, r.ids_crc32) for r in some) for d, some in by_doc.items()}
    assert got == dict(want)
    return len(held), sum(r.length for r in rows)


def test_documents(ready, documents, tokenizer):
    rows = packing.pack(documents).collect()
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    count, total = _check(rows, tokenizer, docs, 2048)
    assert count <= -(-total // 2048) + 1


def test_capacities_hold_and_sequences_are_whole(ready, documents, tokenizer):
    packed = packing.pack(documents, Capacity(512, 3, 120_000), rule="dot", with_ids=True)
    docs = {r.doc_id: _ids(tokenizer, r.text) for r in documents.select("doc_id", "text").collect()}
    rows = packing.sequences(packed).collect()
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) <= 512
        if len(r.pieces) > 1:
            assert len(r.pieces) <= 3 and sum(p.length**2 for p in r.pieces) <= 120_000
        for p in r.pieces:
            assert ids[p.offset : p.offset + p.length] == docs[p.doc_id][p.start : p.start + p.length]
    assert sum(len(r.ids) // 4 for r in rows) == sum(map(len, docs.values()))


def test_odd(ready, odd, empty, tokenizer):
    rows = packing.pack(odd.repartition(5), Capacity(128)).collect()
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    _check(rows, tokenizer, docs, 128)
    assert packing.pack(empty).count() == 0
