from __future__ import annotations

import pytest

from doselake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, _own string, shard int, size string, _nth int, key binary, part int"


@pytest.fixture(scope="session")
def ready(spark):
    return queries.ready(spark)


@pytest.fixture(scope="session")
def documents(ready):
    """The real table; small enough for brute force."""
    return ready.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(ready):
    """Nulls, empty, blank and very long texts, repeats, ties, extra columns with odd names."""
    long = " ".join(f"word{i % 977} thing{i}" for i in range(60_000))
    texts = [
        (1, "a b c d e f g h i j", "s"), (1, "a b c d e f g h i j", "s"),
        (2, "A b c  d e f g\nh i j", "s"), (3, None, "s"), (4, "", "t"), (5, " \n\t ", "t"),
        (6, "one two", None), (7, "one two", None), (8, long, "t"), (9, long + " end", "u"),
        (None, "a b c d e f g h i j", "u"), (None, None, None), (None, "nothing like it at all", "u"),
        (10, "é" * 70, "u"), (-5, "  x  y  z ", "s"), (11, "one two", "s"),
    ]
    return ready.createDataFrame([(*t, "x", 1, "y", 2, b"k", 3) for t in texts], SCHEMA)


@pytest.fixture(scope="session")
def empty(ready):
    return ready.createDataFrame([], SCHEMA)
