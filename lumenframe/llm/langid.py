"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (1 to 3 characters of the lower-cased text, digits as one
class, white space as one space), tf is the share of an n-gram among the text's n-grams of that
length, and idf comes from document counts over all training documents (a Spark aggregation of at
most ``buckets`` counters). The weights are learned by follow-the-regularised-leader with an
elastic-net penalty (proximal, per-coordinate rates), which leaves most of them at zero, on a
bounded sample of training texts; a temperature is fitted on texts held back from that sample.

Scoring reads whole texts and needs no shuffle: the score of a text is a mean of table entries.

Defined results: null text, or text without a letter, is ``und`` with score 0; languages are the
non-null values seen in training; no training rows: every text is ``und`` with score 0; equal rows
with one id are one training row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import fold, table, temperature

BUCKETS = 1 << 16
CELLS = 1 << 24
ORDERS = (1, 2, 3)


def ngrams(text: str, buckets: int = BUCKETS) -> list[np.ndarray]:
    """Hash buckets of the n-grams of each order, in order of place."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = codes.astype(np.uint32)
    plain = c < 128
    digit = plain & (c >= 48) & (c <= 57)
    space = (c == 32) | ((c >= 9) & (c <= 13)) | (c == 0xA0)
    c = np.where(space, np.uint32(32), np.where(digit, np.uint32(48), c))
    c = c[~((c == 32) & np.concatenate([[False], c[:-1] == 32]))] if len(c) else c
    out = []
    h = c * np.uint32(0x9E3779B1) + np.uint32(1)
    for n in ORDERS:
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[n - 1 :] * np.uint32(0xC2B2AE3D)
        g = h ^ (h >> np.uint32(16))
        out.append((g % np.uint32(buckets)).astype(np.int64))
        if len(h) <= 1:
            break
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages): idf x weight
    bias: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        z = self.bias.copy()
        for g in ngrams(text, len(self.table)):
            if len(g):
                z = z + self.table[g].sum(axis=0) / len(g)
        return z


def _features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cols, vals = [], []
    for g in ngrams(text, len(idf)):
        if len(g):
            at, n = np.unique(g, return_counts=True)
            cols.append(at)
            vals.append(n / len(g) * idf[at])
    if not cols:
        return np.zeros(0, np.int64), np.zeros(0)
    at, inv = np.unique(np.concatenate(cols), return_inverse=True)
    return at, np.bincount(inv, np.concatenate(vals))


def document_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all of them; each task adds up its own first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(buckets, np.int64), 0
        mark = np.zeros(buckets, bool)
        for b in batches:
            for t in b.column("text").to_pylist():
                for g in ngrams(t, buckets):
                    mark[g] = True
                df += mark
                mark[:] = False
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *df[at].tolist()], pa.int64())], ["b", "n"]
        )

    src = texts.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    rows = src.mapInArrow(work, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(buckets, np.int64)
    total = 0
    for b, n in zip(rows["b"], rows["n"], strict=True):
        if b < 0:
            total = int(n)
        else:
            counts[int(b)] = int(n)
    return counts, total


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    y: np.ndarray,
    classes: int,
    size: int,
    epochs: int = 4,
    alpha: float = 4.0,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.001,
    seed: int = 10,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (size, classes) and bias by FTRL-proximal steps over the rows in random order."""
    z = np.zeros((size + 1, classes))
    n = np.zeros((size + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        za, na = z[at], n[at]
        w = -(za - np.sign(za) * l1) / ((beta + np.sqrt(na)) / alpha + l2)
        return np.where(np.abs(za) <= l1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            at, x = np.append(at, size), np.append(x, 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[k]] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], w[size]


def train(
    docs: DataFrame,
    keep: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = 700,
    max_languages: int = 2048,
    buckets: int = BUCKETS,
) -> Model | None:
    """Fit on at most ``per_language`` texts of each language, fewer from 58 languages on (the bound
    is on the fit alone). From 257 languages on n-grams share fewer buckets, so that the weights stay
    within ``CELLS`` numbers.

    A language beyond the ``max_languages`` most frequent ones is an error, not left out.
    """
    usable = docs.where(keep & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    found = usable.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    languages = sorted(r[0] for r in found)
    if not languages:
        return None
    buckets = min(buckets, CELLS // len(languages))
    counts, total = document_counts(usable, text_col, buckets)
    idf = np.log((1 + total) / (1 + counts)) + 0.2
    per_language = max(20, min(per_language, 40_000 // len(languages)))
    wanted = {r[0]: min(1.0, 1.5 * per_language / r["count"] + 20 / r["count"]) for r in found}
    share = F.coalesce(*[F.when(F.col(lang_col) == k, F.lit(v)) for k, v in wanted.items()])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(10)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = usable.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), draw.alias("_draw"), share.alias("_share"))
    drawn = sample.where(F.col("_draw") < F.col("_share")).groupBy("_lang", "_draw").agg(F.min("_text").alias("_text"))
    most = len(languages) * (2 * per_language + 100)  # repeated rows are one row, so the share draws fewer than this
    rows = drawn.orderBy("_draw", "_lang").limit(most).collect()
    rows.sort(key=lambda r: (r[0], r["_draw"], r["_text"]))
    by: dict[str, list[str]] = {}
    for r in rows:
        if len(by.setdefault(r[0], [])) < per_language:
            by[r[0]].append(r["_text"])
    x, y = [], []
    for k, name in enumerate(languages):
        for t in by.get(name, []):
            x.append(_features(t, idf))
            y.append(k)
    y = np.array(y, dtype=np.int64)
    back = np.arange(len(y)) % 5 == 0  # held back for the temperature
    fit = np.flatnonzero(~back)
    w, bias = ftrl([x[k] for k in fit], y[fit], len(languages), buckets)
    logits = np.array([bias + v @ w[at] for (at, v), b in zip(x, back, strict=True) if b])
    t = temperature(logits, y[back]) if len(logits) else 1.0
    return Model(languages, (w * idf[:, None]).astype(np.float32), bias, t)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row: the likeliest language and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores = [], []
            for t in b.column("text").to_pylist():
                if t is None or m is None or not any(map(str.isalpha, t)):
                    names.append("und")
                    scores.append(0.0)
                    continue
                z = m.logits(t) / m.temperature
                p = np.exp(z - z.max())
                k = int(p.argmax())
                names.append(m.languages[k])
                scores.append(float(p[k] / p.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, "id long, lang_pred string, score double")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, fold("doc_id", 4) != 2)
    return predict(docs, model).select(
        F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )
