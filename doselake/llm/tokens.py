"""Token ids with public byte-level vocabularies.

A vocabulary is a file of the public tokenizers, read on the driver and broadcast as text
(a few MB): ranks in lines, or the JSON of a byte-level BPE, whose ids are its ranks.
"""

from __future__ import annotations

import base64
import json
import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

from . import text

FOLDER = "/opt/tokenizers"
VOCABULARY = f"{FOLDER}/byte_bpe_50k.tiktoken"
JSON_VOCABULARY = f"{FOLDER}/byte_bpe_50k.json"
END_OF_TEXT = 50256  # free in the vocabulary
#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pieces without the slow look-ahead, for texts in which `_RUNS` finds nothing: of the blanks before a
#: word, all but the last are one piece, which is a single blank where there are two; at the end, all are.
PLAIN_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_BLANK = r"[\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_RUNS = rf"{_BLANK}{{3}}|{_BLANK}{{2}}\z"  # three blanks in a row, or two at the end
_ODD = rf"\A{_BLANK}|{_BLANK}\z|\A\z"  # a word that makes a run with the space before or after it


def read(path: str) -> str:
    """A vocabulary's text, by its path or by its name among the public tokenizers."""
    if not os.path.isabs(path):
        path = os.path.join(FOLDER, path)
    with open(path, encoding="utf-8") as file:
        return file.read()


def shared(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(read(path))


def _letters() -> dict[str, int]:
    """Bytes by the letters that stand for them in JSON: visible ones for themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _ranks(vocabulary: str) -> dict[bytes, int]:
    if not vocabulary.startswith("{"):
        lines = (line.split() for line in vocabulary.splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in lines}
    model, letters = json.loads(vocabulary)["model"], _letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    # Merged in the order of their ids, or ids could not serve as ranks.
    if any(model["vocab"][a + b] != len(letters) + i for i, (a, b) in enumerate(pairs)):
        raise ValueError("ids do not follow the merges")
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}


@cache
def encoding(vocabulary: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The encoding of a vocabulary's text; special tokens are text like other text."""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(vocabulary), special_tokens={})


class Encoder:
    """Ids of whole texts."""

    def __init__(self, vocabulary: str):
        self.encoding = encoding(vocabulary)

    def ids(self, value: str | None) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(value or ""), np.uint32)

    def count(self, value: str) -> int:
        return len(self.encoding.encode_ordinary(value))


class ColumnEncoder(Encoder):
    """Ids of columns of whole texts; a word that comes again in a column is encoded once.

    A piece of `PATTERN` ends before every space that has another blank on one side at most.
    Where `_RUNS` finds nothing these are all spaces, so the ids of such a text are those of
    its first word, and of each other word with its space. Other texts are encoded whole.
    """

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        self.plain = encoding(vocabulary, PLAIN_PATTERN)
        ranks = _ranks(vocabulary)
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True

    def _alone(self, values: list[str]) -> pa.Array:
        """The ids of each value, as bytes."""
        found = [self.encoding.encode_ordinary(value) for value in values]
        ends = np.cumsum([0, *map(len, found)])
        return _as_bytes(np.fromiter(chain.from_iterable(found), np.uint32, ends[-1]), ends)

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of each word with a space before it, as bytes."""
        odd = pc.match_substring_regex(words, _ODD)
        usual = words.filter(pc.invert(odd))
        # Joined, they are cut as they are alone, and only the first id of each begins with a space.
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(usual)], usual), pa.scalar(" ", words.type))[0].as_py()
        ids = np.array(self.plain.encode_ordinary(f" {joined}" if len(usual) else ""), np.uint32)
        found = _as_bytes(ids, np.append(np.flatnonzero(self.spaced[ids]), len(ids)))
        if len(usual) < len(words):
            found = pa.concat_arrays([found, self._alone([f" {word}" for word in words.filter(odd).to_pylist()])])
            found = found.take(pa.array(np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))))
        return found

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column without nulls, text after text, and where each text's start and the last ends."""
        runs = pc.match_substring_regex(texts, _RUNS)
        split = pc.split_pattern(pc.if_else(runs, pa.scalar("", texts.type), texts), " ")
        bounds = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))
        words, firsts = split.flatten(), bounds[:-1]
        whole = self._alone(pc.if_else(runs, texts, words.take(pa.array(firsts))).to_pylist())
        later = np.ones(len(words), bool)
        later[firsts] = False
        words = words.filter(pa.array(later)).dictionary_encode()
        which = np.empty(len(later), np.int64)
        which[later] = words.indices.to_numpy()
        which[firsts] = len(words.dictionary) + np.arange(len(texts))
        found = pa.concat_arrays([self._words(words.dictionary), whole]).take(pa.array(which))
        data, offsets = text.flat(found)
        return data.view(np.uint32), offsets[bounds] // 4


def _as_bytes(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids)]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)
