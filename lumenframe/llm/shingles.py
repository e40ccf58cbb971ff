"""Shingles of words: their hashes, sets, dealing keys, and the exact similarity of two sets.

A text is the set of its shingles of five words (ASCII lower case, split at ASCII white space; fewer
words: one shingle). Texts whose sets are at a Jaccard similarity of 0.8 share one of ``BANDS`` keys made
of ``ROWS`` minima each with a chance of 1 - (1 - 0.8^4)^24, over 0.99999.

Null text is the empty text; texts without words have equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import texts_of

WORDS, BANDS, ROWS = 5, 24, 4
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RNG = np.random.default_rng(8)
_MULT = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_hashes(text: str, words: int, seed: int = 42) -> list[int]:
    """Hashes of all shingles of a text; fewer words than a shingle: one of all words."""
    parts = text.encode("utf-8").translate(_LOWER).split()
    joined = b" ".join(parts)
    if len(parts) < words:
        return [xxhash.xxh64_intdigest(joined, seed)]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = end - size
    digest = xxhash.xxh64_intdigest
    last = len(parts) - words + 1
    return [
        digest(joined[s:e], seed)
        for s, e in zip(start[:last].tolist(), end[words - 1 :].tolist(), strict=True)
    ]


def shingles(text: str) -> np.ndarray:
    """The distinct shingles of a text as hashes (uint64), in order."""
    return np.unique(np.array(shingle_hashes(text, WORDS), dtype=np.uint64))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key for each band: a hash of its minima."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for lo in range(0, len(found), 512):
            low = np.minimum(low, ((found[lo : lo + 512, None] ^ _MASK) * _MULT).min(axis=0))
        key = np.arange(BANDS, dtype=np.uint64)
        for column in low.reshape(BANDS, ROWS).T:
            key = ((key ^ (key >> np.uint64(29))) + column) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(32))


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("same")


def set_node(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, items): the sets of the rows named in ``wanted`` (id, same)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in texts_of(b)]
            node = np.array([set_node(f) for f in found], np.uint64).view(np.int64)
            items = pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), items], ["node", "items"])

    rows = docs.select(*row_key(id_col, text_col), F.col(text_col).cast("string").alias("text")).alias("d")
    w = wanted.alias("w")
    same = (F.col("d.same") == F.col("w.same")) & F.col("d.id").eqNullSafe(F.col("w.id"))
    picked = rows.join(w, same, "left_semi").select("text")
    return picked.mapInArrow(work, "node long, items array<long>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are at a Jaccard similarity of 0.8 or more."""
    a = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    met = pairs.join(a, "u").join(b, "v")
    return met.where(both * 9 >= (F.size("a") + F.size("b")) * 4).select("u", "v")
