"""Rows that every document operator must stand."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Extra columns with names that the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, _id string, shard string, label string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    long = words(rng, 30_000)
    some = words(rng, 60)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, long), (7, some), (8, some), (9, some + " tail")]
    rows += [(None, some), (None, None), (7, some), (10, "é ü 漢字 🙂   x"), (11, "!!! ??? ...")]
    return rows + [(k, words(rng, rng.randint(1, 80))) for k in range(20, 60)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rng = random.Random(5)
    rows = [
        (i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), None if t is None else len(t), 0, "k", "i", "s", None)
        for i, t in odd_texts
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def medium() -> str:
    if not Path(MEDIUM).exists():
        pytest.skip("no tables")
    return MEDIUM
