"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Each token bucket has a fixed sparse random index vector; its word vector is the sum of the index
vectors of the two tokens on either side, over the whole corpus (one Spark aggregation of
``BUCKETS`` x ``DIM`` sums; every task adds up its own before the shuffle). A document is the mean of
its tokens' word vectors and of their index vectors, with the length of the latter (short for
varied texts, long for repetitive ones), how alike neighbouring tokens are, and the log of the
number of tokens. A tanh layer and a logistic unit, trained in numpy on a bounded sample of labelled
documents, give a logit; a temperature fitted on documents held back from that sample calibrates it,
after a shift from the balanced sample to the class shares of all training labels.

Tokens are runs of letters, of digits, or of signs; a word in capitals also gives a marker token.

Defined results: null or empty text has no tokens and gets the score of the zero vector; long texts
are read whole; without labels of both classes every score is the share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import (
    class_log_odds,
    fold,
    labelled_sample,
    table,
    temperature,
    texts_of,
)

BUCKETS, DIM, NONZERO = 8192, 32, 6
_TOKEN = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
_KEEP = 400_000
_PAD = BUCKETS  # the token between two documents, whose index vector is zero


def index_vectors(seed: int = 3) -> np.ndarray:
    """(BUCKETS + 1, DIM): sparse vectors of +1 and -1, and zeros for the pad."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS + 1, DIM), np.float32)
    for k in range(BUCKETS):
        out[k, rng.permutation(DIM)[:NONZERO]] = rng.permutation([1, -1] * (NONZERO // 2))
    return out


class Tokens:
    """Token buckets of texts; the tokens of each piece between spaces are kept."""

    def __init__(self) -> None:
        self._known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        out = []
        for t in _TOKEN.findall(piece):
            low = t.lower()
            if len(t) > 1 and t != low and t.isupper():
                out.append(zlib.crc32(b"<CAPITALS>") % BUCKETS)
            out.append(zlib.crc32(low.encode()) % BUCKETS)
        return np.array(out, dtype="<u2").tobytes()

    def of(self, text: str) -> np.ndarray:
        known, pieces = self._known, text.split()
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u2")
        except KeyError:
            if len(known) > _KEEP:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = self._piece(p)
            return np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u2")


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(BUCKETS, DIM) word vectors of unit length from the contexts of all documents."""
    index = index_vectors()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sums = Tokens(), np.zeros((BUCKETS + 1, DIM))
        held: list[np.ndarray] = []
        size = 0
        pad = np.array([_PAD, _PAD], dtype="<u2")

        def add() -> None:
            t = np.concatenate([pad, *held])
            r = index[t]
            around = np.zeros_like(r)
            for k in (1, 2):
                around[k:] += r[:-k]
                around[:-k] += r[k:]
            for d in range(DIM):
                sums[:, d] += np.bincount(t, around[:, d], minlength=BUCKETS + 1)

        for b in batches:
            for text in texts_of(b):
                held += [tokens.of(text), pad]
                size += len(held[-2]) + 2
                if size > 200_000:
                    add()
                    held, size = [], 0
        if held:
            add()
        used = np.flatnonzero(np.abs(sums[:BUCKETS]).sum(axis=1))
        columns = [pa.array(used, pa.int64()), *(pa.array(sums[used, d].astype(np.int64)) for d in range(DIM))]
        yield pa.RecordBatch.from_arrays(columns, ["b", *(f"c{d}" for d in range(DIM))])

    src = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    schema = "b long, " + ", ".join(f"c{d} long" for d in range(DIM))
    sums = src.mapInArrow(work, schema).groupBy("b").agg(*[F.sum(f"c{d}").alias(f"c{d}") for d in range(DIM)])
    rows = sums.toPandas()  # BUCKETS rows at most
    out = np.zeros((BUCKETS, DIM), np.float32)
    if len(rows):
        x = rows.drop(columns="b").to_numpy(np.float64)
        out[rows["b"].to_numpy()] = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return out


def pooled(t: np.ndarray, words: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The feature vector of one document's token buckets."""
    if not len(t):
        return np.zeros(2 * DIM + 4, np.float32)
    count = np.bincount(t, minlength=BUCKETS)
    at = np.flatnonzero(count)
    share = (count[at] / len(t)).astype(np.float32)
    mean_word, mean_index = share @ words[at], share @ index[at]
    alike = [float((t[k:] == t[:-k]).mean()) if len(t) > k else 0.0 for k in (1, 2)]
    extra = [float(np.sqrt((share**2).sum())), *alike, float(np.log1p(len(t)) / 10)]
    return np.concatenate([mean_word, mean_index, np.array(extra, np.float32)])


@dataclass
class Network:
    words: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    shift: float = 0.0
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (self.logits(x) + self.shift) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, words: np.ndarray, log_odds: float, hidden: int = 24, epochs: int = 120, seed: int = 33) -> Network:
    """Train the network by Adam on 4 of 5 rows; calibrate on the rest."""
    rng = np.random.default_rng(seed)
    back = np.arange(len(y)) % 5 == 0
    xs, ys = x[~back], y[~back].astype(float)
    centre, scale = xs.mean(axis=0), xs.std(axis=0) + 1e-3
    xs = (xs - centre) / scale
    p = [
        rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]),
        np.zeros(hidden),
        rng.standard_normal(hidden) / np.sqrt(hidden),
        np.zeros(1),
    ]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    weight = np.where(ys > 0, 0.5 / max(ys.mean(), 1e-9), 0.5 / max(1 - ys.mean(), 1e-9))
    for _ in range(epochs):
        order = rng.permutation(len(ys))
        for lo in range(0, len(order), 128):
            k = order[lo : lo + 128]
            h = np.tanh(xs[k] @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - ys[k]) * weight[k] / len(k)
            dh = e[:, None] * p[2] * (1 - h * h)
            grads = [xs[k].T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ e + 1e-4 * p[2], e.sum(keepdims=True)]
            step += 1
            for q, g, a, b in zip(p, grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    net = Network(words, centre, scale, p[0], p[1], p[2], float(p[3][0]))
    if back.any() and 0 < y[back].sum() < back.sum():
        net.temperature = max(0.2, temperature(net.logits(x[back]), y[back].astype(float)))
    net.shift = log_odds * net.temperature  # the fit saw both classes as equally frequent
    return net


def train(docs: DataFrame, labels: DataFrame, keep: Column, per_class: int = 2000) -> tuple[Network | None, float]:
    """Fit on at most ``per_class`` documents of either label; also the log odds of label 1."""
    odds = class_log_odds(labels, "quality", keep)
    sample = labelled_sample(docs, labels, "quality", keep, per_class)
    y = np.array([label for _, label in sample])
    if not len(y) or y.min() == y.max():
        return None, odds
    words, index, tokens = word_vectors(docs), index_vectors(), Tokens()
    x = np.array([pooled(tokens.of(t), words, index) for t, _ in sample])
    order = np.random.default_rng(1).permutation(len(y))
    return fit(x[order], y[order], words, odds), odds


def score(docs: DataFrame, net: Network | None, odds: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of label 1, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # BUCKETS x DIM numbers
    base = float(1 / (1 + np.exp(-odds)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, tokens, index = shared.value, Tokens(), index_vectors()
        for b in batches:
            texts = texts_of(b)
            for lo in range(0, len(texts), 512):
                part = texts[lo : lo + 512]
                if net is None:
                    p = np.full(len(part), base)
                else:
                    p = net.probability(np.array([pooled(tokens.of(t), net.words, index) for t in part]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, len(part)), pa.array(p.astype(np.float64))], ["id", "score"]
                )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, "id long, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net, odds = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score(docs, net, odds).select(
        F.col("id").alias("doc_id"),
        (fold("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
