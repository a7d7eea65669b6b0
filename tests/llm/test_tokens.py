"""Token sequences, slots, shards on disk, and edit-aware counts, against plain encoding."""

from __future__ import annotations

import json
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from doselake.llm import counting, queries, tokens, training_order
from doselake.llm.training_order import Permutation


def _plain(text):
    return tokens.encoding(tokens.read(tokens.VOCABULARY)).encode_ordinary(text or "")


def test_ids_are_those_of_the_tokenizers_library():
    own = Tokenizer.from_file(tokens.JSON_VOCABULARY)
    own.encode_special_tokens = True
    draw = random.Random(3)
    parts = ["a", "It's", " ", "  ", "\n", "\t", "é", "ß", "\u00a0", "\u3000", "\x1c", "\x85", "12", "!?", "word", "'ll", "日本", "<|endoftext|>"]
    encoders = [tokens.Encoder(tokens.read(path)) for path in (tokens.VOCABULARY, tokens.JSON_VOCABULARY)]
    for _ in range(3000):
        value = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        for encoder in encoders:
            assert encoder.ids(value).tolist() == own.encode(value, add_special_tokens=False).ids, value
            assert encoder.count(value) == len(encoder.ids(value))


def test_columns_of_texts_get_the_ids_of_the_tokenizers_library():
    own = Tokenizer.from_file(tokens.JSON_VOCABULARY)
    own.encode_special_tokens = True
    draw = random.Random(4)
    blanks = [" ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x85", "\u00a0", "\u1680", "\u2000", "\u200a", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
    words = ["a", "It's", "'ll", "é", "日本", "12", "!?", "\x1c", "\u200b", "\u180e", "word", "<|endoftext|>"]
    texts = ["", " ", "  ", "a  b", "a   b", "a \n", "a\n\nb", "a\n\n b", "a  "]
    for _ in range(4000):
        parts = [draw.choice(words) + "".join(draw.choices(blanks, k=draw.choice([0, 1, 1, 2, 3]))) for _ in range(draw.randint(0, 5))]
        texts.append("".join(draw.choices(blanks, k=draw.randint(0, 2)) + parts))
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = tokens.ColumnEncoder(tokens.read(tokens.VOCABULARY))
    for kind in (pa.string(), pa.large_string()):
        for size in (1, 7, len(texts)):
            for at in range(0, min(60 * size, len(texts)), size):
                ids, bounds = encoder.column(pa.array(texts, kind).slice(at, size))
                found = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                assert found == want[at : at + size]


def test_words_of_a_column_are_encoded_once():
    encoder = tokens.ColumnEncoder(tokens.read(tokens.VOCABULARY))
    met = []

    class Noted:
        def __init__(self, under):
            self.under = under

        def encode_ordinary(self, value):
            met.append(value)
            return self.under.encode_ordinary(value)

    encoder.encoding, encoder.plain = Noted(encoder.encoding), Noted(encoder.plain)
    texts = ["Some words, it's said.\n\nMore  words\n " + "unlikely repeated words " * 500 + "end"] * 50
    ids, bounds = encoder.column(pa.array(texts))
    assert ids.tolist() == _plain(texts[0]) * 50 and len(bounds) == 51
    assert sum(map(len, met)) < len(texts[0]) / 10
    runs = "code  \n   indented " * 40
    ids, _ = encoder.column(pa.array([runs, "x"]))
    assert ids.tolist() == _plain(runs) + _plain("x") and runs in met
    met.clear()
    encoder.column(pa.array(["日本語" * 50, "", "one", "b c"]))
    assert sum(map(len, met)) == 150 + 3 + 1 + 2  # a first word is not encoded again


@pytest.mark.parametrize("count", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutation_is_a_bijection(count):
    p = Permutation(count, key=9)
    slots = p.slot(np.arange(count))
    assert sorted(slots.tolist()) == list(range(count))
    assert p.number(slots).tolist() == list(range(count))
    if count > 100:
        assert Permutation(count, key=10).slot(np.arange(count)).tolist() != slots.tolist()


def _rebuilt(folder, total):
    found = {}
    for doc, number, ids in training_order.read(folder, 0, total + 5):
        found.setdefault(doc, []).append((number, ids.tolist()))
    return found


def test_shards_hold_every_token(ready, documents, tmp_path):
    folder = f"file://{tmp_path}/order"
    rows = training_order.materialise(documents, folder, length=64, per_shard=100).collect()
    slots = sorted(r.slot for r in rows)
    assert slots == list(range(len(rows)))
    layout = json.loads((tmp_path / "order" / "layout.json").read_text())
    assert layout["sequences"] == len(rows)
    assert len(list((tmp_path / "order").glob("shard-*.bin"))) == -(-len(rows) // 100)
    found = _rebuilt(folder, len(rows))
    for doc, text in documents.select("doc_id", "text").collect():
        ids = [i for _, part in sorted(found.get(doc, [])) for i in part]
        assert ids == (_plain(text) + [tokens.END_OF_TEXT] if text else [])
    resumed = list(training_order.read(folder, 150, 3))
    everything = list(training_order.read(folder, 0, len(rows)))
    assert [r[:2] for r in resumed] == [r[:2] for r in everything[150:153]]


def test_slots_do_not_depend_on_partitions(ready, documents, tmp_path):
    one = training_order.materialise(documents.coalesce(1), f"file://{tmp_path}/a", length=64)
    many = training_order.materialise(documents.repartition(7), f"file://{tmp_path}/b", length=64)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_odd_sequences(ready, odd, empty, tmp_path):
    rows = training_order.materialise(odd, f"file://{tmp_path}/odd", length=32).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    per_doc = {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
    assert not {3, 4} & set(per_doc)  # null and empty texts
    assert len(per_doc[1]) == 2  # a repeated row is there twice
    assert len(per_doc[None]) == 2
    assert training_order.materialise(empty, f"file://{tmp_path}/none").count() == 0
    assert list(training_order.read(f"file://{tmp_path}/none", 0, 5)) == []


def test_records_are_laid_out_as_described(ready, odd, tmp_path):
    rows = training_order.materialise(odd, f"file://{tmp_path}/odd", length=32, per_shard=50).collect()
    assert len({r.shard for r in rows}) > 3
    ids = {}
    for doc, text in odd.select("doc_id", "text").collect():
        ids.setdefault(doc, []).append(_plain(text) + [tokens.END_OF_TEXT] if text else [])
    size = training_order.stride(32)
    shards = {s: (tmp_path / "odd" / f"shard-{s:08d}.bin").read_bytes() for s in {r.shard for r in rows}}
    assert sum(map(len, shards.values())) == size * len(rows)
    for r in rows:
        assert (r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * size)
        record = shards[r.shard][r.byte_offset : r.byte_offset + size]
        assert zlib.crc32(record) == r.record_crc32
        doc, number, used = struct.unpack_from("<qii", record)
        assert (doc, number, used) == (-(1 << 63) if r.doc_id is None else r.doc_id, r.seq_no, r.n_tokens)
        assert not any(record[16 + 2 * used :])
        found = list(struct.unpack_from(f"<{used}H", record, 16))
        assert found in [own[32 * number : 32 * number + 32] for own in ids[r.doc_id]]


def _edited(text, edits):
    text = text or ""
    for _, start, length, insert in sorted(edits):
        start = min(max(start, 0), len(text))
        text = text[:start] + insert + text[start + max(length, 0) :]
    return text


def test_recount_is_plain_count(ready, documents):
    edits = queries.edits_of(documents)
    rows = counting.recount(counting.trees(documents), edits).collect()
    by_doc = {}
    for r in edits.collect():
        by_doc.setdefault(r.doc_id, []).append((r.seq, r.start, r.length, r.insert))
    texts = dict(documents.select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        after = _edited(texts[r.doc_id], by_doc[r.doc_id])
        assert (r.n_edits, r.tokens_before) == (3, len(_plain(texts[r.doc_id])))
        assert (r.tokens_after, r.chars_after) == (len(_plain(after)), len(after))
    long = [r for r in rows if r.chars_after > 5000]
    assert long and all(r.chars_encoded < r.chars_after / 2 for r in long)


def test_random_edits_keep_the_tree_right():
    draw = random.Random(5)
    encoder = tokens.Encoder(tokens.read(tokens.VOCABULARY))
    for _ in range(60):
        text = " ".join(draw.choice(["ab", "c d", "\n", "It's", "x\n", "é", "12"]) for _ in range(draw.randint(0, 200)))
        parts = [(len(p), encoder.count(p)) for p in counting.leaves(text, 20)]
        counted = counting.Counted(text, parts)
        for _ in range(25):
            start, length = draw.randint(-2, len(text) + 2), draw.randint(-1, 40)
            insert = draw.choice(["", " ", "\n", "q", " new words here", "é é", " long" * 90])
            counted.edit(start, length, insert, encoder)
            at = min(max(start, 0), len(text))
            text = text[:at] + insert + text[at + max(length, 0) :]
            assert counted.text == text
            assert counted.tree.total() == (len(text), len(_plain(text)))


def test_odd_recounts(ready, odd, empty):
    edits = ready.createDataFrame(
        [(1, 0, 2, 1, "X"), (3, 0, 5, 5, "new text"), (99, 0, 0, 0, "lost"), (None, 0, 0, 0, "lost"), (6, None, None, None, None)],
        "doc_id long, seq int, start int, length int, insert string",
    )
    rows = counting.recount(counting.trees(odd), edits).collect()
    assert len(rows) == odd.count()
    by_doc = {r.doc_id: r for r in rows}
    assert by_doc[3].tokens_before == 0 and by_doc[3].tokens_after == len(_plain("new text"))
    assert by_doc[6].n_edits == 1 and by_doc[6].tokens_after == by_doc[6].tokens_before
    assert sum(r.doc_id == 1 and r.n_edits == 1 for r in rows) == 2
    assert counting.recount(counting.trees(empty), edits).count() == 0
