"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel compares two words by the subsequences of four characters they share, taken within six
places, each skipped place costing a factor ``DECAY``; so ``id-iot``, ``idxiot`` and inflected forms
stay close to ``idiot``. Words are lower-cased, common look-alikes (0 for o, @ for a ...) and
accents undone, other signs dropped, letters of all scripts kept, and single letters in a row joined (``i d i o t``).

Training sentences: every sentence of a document labelled clean is clean, and a toxic document
holds at least one toxic sentence, of which at least one word is to blame (a multiple-instance
support vector machine: first the words that only toxic documents share, then, in turn, a fit and a
new choice of each document's worst word, and of the clean words that look worst). Landmarks are
words of both sides; the kernel matrix of the landmarks gives the Nystroem map, and a linear SVM is
fitted on it. A text's score is the worst word's margin, calibrated on texts held back.

As the kernel is a dot product of counted subsequences, the landmarks' weights fold into one
weight for each of 2^20 hashes of subsequences of code points: scoring a word is a sum of table entries, whatever the
number of landmarks. Words are scored once for each worker process while they stay in its memory.

Defined results: null or empty texts get the score of the bias alone, words of one letter have
no subsequence and score the same; equal texts score equal; very long words are scored whole; without labels of both classes every score is the share of
toxic labels.
"""

from __future__ import annotations

import itertools
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import class_log_odds, fold, labelled_sample, table, texts_of

DECAY, SPAN, TABLE_BITS = 0.6, 6, 20
_GAPS = [(a, b, c) for a, b, c in itertools.combinations(range(1, SPAN), 3)]
_NORM = {s: DECAY ** (s - 3) for s in range(3, SPAN)}
#: Signs that stand for letters.
_LOOKS = str.maketrans("013457@$!|", "oleastasil")
#: Accents, Hebrew points and Arabic vowel signs; signs of other scripts (Devanagari vowels, kana voicing) tell words apart.
_ACCENTS = re.compile("[\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0670]")
_EDGE = ".,;:?\"'()[]{}<>*_-"
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
_KEEP, _KEEP_LETTERS = 400_000, 20_000_000
_LONG = 1 << 15  # letters of a word that is read in pieces


def _plain(word: str) -> str:
    """Base letters of a lower-cased word; look-alikes are letters only next to letters."""
    if word.isascii() and word.isalpha():
        return word
    word = word.strip(_EDGE).rstrip("!")
    if not word.isascii():
        word = unicodedata.normalize("NFKD", word)
        word = _ACCENTS.sub("", word)
    if not word.isalpha() and any(map(str.isalpha, word)):
        word = word.translate(_LOOKS)
    return "".join(c for c in word if c.isalpha() or unicodedata.category(c)[0] == "M")


def words_of(text: str) -> list[str]:
    """The words of a text; three or more single letters in a row are one word."""
    words = text.lower().split()
    single = [k for k, w in enumerate(words) if len(w) == 1]
    if len(single) >= 3:
        start = 0
        for k in range(1, len(single) + 1):
            if k == len(single) or single[k] != single[k - 1] + 1:
                if k - start >= 3:
                    words.append("".join(words[i] for i in single[start:k]))
                start = k
    return words


def _hashed(*places: np.ndarray) -> np.ndarray:
    """The table entry of four characters (whole code points), by hash."""
    h = np.zeros(len(places[0]), np.uint64)
    with np.errstate(over="ignore"):
        for code in places:
            h = (h ^ (h >> np.uint64(29)) ^ code) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _of_short(plain: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, plain), np.int64, len(plain))
    code = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(plain)), size)
    who, what, weight = [], [], []
    for a, b, c in _GAPS:
        if len(code) <= c:
            continue
        ok = word[:-c] == word[c:]
        n = len(code) - c
        x = _hashed(code[:n], code[a : a + n], code[b : b + n], code[c:])
        who.append(word[:-c][ok])
        what.append(x[ok])
        weight.append(np.full(int(ok.sum()), _NORM[c]))
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    w, x, v = np.concatenate(who), np.concatenate(what), np.concatenate(weight)
    key, same = np.unique((w << TABLE_BITS) | x, return_inverse=True)  # a subsequence may occur several times
    norm = np.sqrt(np.bincount(key >> TABLE_BITS, np.bincount(same, v) ** 2, minlength=len(plain)))
    return w, x, v / norm[w]


def _of_long(plain: str) -> tuple[np.ndarray, np.ndarray]:
    """(code, weight) of the subsequences of one long word, each once; read in pieces, so memory follows the table."""
    total = np.zeros(1 << TABLE_BITS)
    for lo in range(0, len(plain), _LONG):
        code = np.frombuffer(plain[lo : lo + _LONG + SPAN - 1].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        for a, b, c in _GAPS:
            n = min(_LONG, len(code) - c)
            if n > 0:
                x = _hashed(code[:n], code[a : a + n], code[b : b + n], code[c : c + n])
                total += np.bincount(x, minlength=len(total)) * _NORM[c]
    at = np.flatnonzero(total)
    return at, total[at] / np.sqrt((total[at] ** 2).sum())


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of all subsequences of all words, scaled to unit length by word."""
    plain = ["^" + _plain(w) + "$" for w in words]
    long = [k for k, p in enumerate(plain) if len(p) > _LONG]
    w, x, v = _of_short([p if len(p) <= _LONG else "" for p in plain])
    if not long:
        return w, x, v
    parts = [_of_long(plain[k]) for k in long]
    who = [np.full(len(at), k) for k, (at, _) in zip(long, parts, strict=True)]
    return np.concatenate([w, *who]), np.concatenate([x, *[p[0] for p in parts]]), np.concatenate([v, *[p[1] for p in parts]])


def _batches(words: list[str], count: int, letters: int = 200_000) -> Iterator[tuple[int, int]]:
    """Ranges of at most so many words and, unless it is a single word, letters."""
    lo = held = 0
    for k, w in enumerate(words):
        if k > lo and (k - lo >= count or held + len(w) > letters):
            yield lo, k
            lo, held = k, 0
        held += len(w)
    if lo < len(words):
        yield lo, len(words)


@dataclass
class Model:
    weight: np.ndarray  # one for each subsequence
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for lo, hi in _batches(words, 10_000):  # the subsequences of all words would be many
            part = words[lo:hi]
            w, x, v = subsequences(part)
            out[lo:hi] = np.bincount(w, v * self.weight[x], minlength=len(part)) + self.bias
        return out


class Scorer:
    """Scores texts, keeping the margins of the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.margin: dict[str, float] = {}
        self.letters = 0  # of the words kept

    def worst(self, texts: list[str]) -> list[tuple[float, str]]:
        """The worst word of each text and its margin; no word: the bias and the empty word."""
        return [top for lo, hi in _batches(texts, 10_000, 4_000_000) for top in self._worst(texts[lo:hi])]

    def _worst(self, texts: list[str]) -> list[tuple[float, str]]:
        split = [words_of(t) for t in texts]
        if len(self.margin) > _KEEP or self.letters > _KEEP_LETTERS:
            self.margin.clear()
            self.letters = 0
        new = [w for w in set(itertools.chain.from_iterable(split)) if w not in self.margin]
        self.margin.update(zip(new, self.model.margins(new).tolist(), strict=True))
        self.letters += sum(map(len, new))
        out = []
        for words in split:
            if words:
                top = max(words, key=self.margin.__getitem__)
                out.append((self.margin[top], top))
            else:
                out.append((self.model.bias, ""))
        return out


def _kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel matrix of the words a and the landmarks b; only shared subsequences are multiplied."""
    wb, xb, vb = subsequences(b)
    codes = np.unique(xb)
    out = np.zeros((len(a), len(b)))
    if not len(codes):
        return out
    marks = np.zeros((len(codes), len(b)), np.float32)
    np.add.at(marks, (np.searchsorted(codes, xb), wb), vb)
    for lo, hi in _batches(a, 500):
        wa, xa, va = subsequences(a[lo:hi])
        at = np.minimum(np.searchsorted(codes, xa), len(codes) - 1)
        hit = np.flatnonzero(codes[at] == xa)
        hit = hit[np.argsort(wa[hit], kind="stable")]
        if len(hit):
            first = np.flatnonzero(np.diff(wa[hit], prepend=-1))
            rows = marks[at[hit]] * va[hit, None].astype(np.float32)
            out[lo + wa[hit][first]] = np.add.reduceat(rows, first, axis=0)
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear SVM with a squared hinge, by accelerated gradient steps; y is -1 or 1."""
    n, d = x.shape
    xb = np.concatenate([x, np.ones((n, 1))], axis=1)
    step = 1.0 / (1e-3 + 2 * c * np.linalg.eigvalsh(xb.T @ (xb * weight[:, None])).max())
    w = np.zeros(d + 1)
    v = w.copy()
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (xb @ v))
        grad = 1e-3 * np.append(v[:-1], 0) - 2 * c * xb.T @ (weight * slack * y)
        new = v - step * grad
        v = new + k / (k + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def _different(texts: list[str]) -> list[int]:
    """Indices of texts that are not near-copies of an earlier one, by eight minima of word hashes."""
    seen: dict[tuple[int, int], list[int]] = {}
    out = []
    mult = np.random.default_rng(5).integers(1, 1 << 62, 8, dtype=np.uint64) | np.uint64(1)
    for k, t in enumerate(texts):
        h = np.array([xxhash.xxh64_intdigest(w.encode()) for w in set(t.split())] or [0], dtype=np.uint64)
        low = [(i, int((h * m).min())) for i, m in enumerate(mult)]
        met = Counter(j for key in low for j in seen.get(key, ())[:50])
        if met and max(met.values()) >= 4:
            continue
        out.append(k)
        for key in low:
            seen.setdefault(key, []).append(k)
    return out


def _beginnings(word: str) -> list[str]:
    return [word[:k] for k in range(5, len(word))] + ([word] if len(word) > 1 else [])


def fit(sample: list[tuple[str, int]], log_odds: float, landmarks: int = 160, rounds: int = 3, seed: int = 9) -> Model | None:
    """Train on labelled texts; ``log_odds`` is log(toxic / clean) where the model will be used."""
    kept = _different([t for t, _ in sample])
    sample = [sample[k] for k in kept]
    back = [sample[k] for k in range(0, len(sample), 5)]
    train, plain = [], {}
    for k, (t, y) in enumerate(sample):
        if k % 5:
            words = {w for s in _SENTENCE.split(t) for w in words_of(s)}
            plain.update({w: sys.intern(_plain(w)) for w in words if w not in plain})
            train.append(({plain[w] for w in words}, y))
    del plain
    toxic, clean = Counter(), Counter()
    for ws, y in train:
        (toxic if y else clean).update(ws)
    n1, n0 = sum(y for _, y in train), sum(1 - y for _, y in train)
    if not n1 or not n0:
        return None
    rng = np.random.default_rng(seed)
    # words and word beginnings that toxic documents alone hold, so often that none would by chance
    in_toxic, in_clean = Counter(), Counter()
    for ws, y in train:
        if y:
            in_toxic.update({u for w in ws for u in _beginnings(w)})
    in_toxic = Counter({u: n for u, n in in_toxic.items() if n >= 3})
    for ws, y in train:
        if not y:
            in_clean.update({u for w in ws for u in _beginnings(w) if u in in_toxic})
    tried = len(in_toxic)
    floor = max(3.0, np.log(max(tried, 1) / 0.01) / np.log((n1 + n0) / n1))
    signs = {u for u, n in in_toxic.items() if n >= floor and in_clean[u] * n1 / n0 <= 0.02 * n}
    blamed = {w for w in toxic if not clean[w] and signs.intersection(_beginnings(w))}
    if not blamed:
        blamed = {w for w, _ in sorted(toxic.items(), key=lambda x: (-x[1] + clean[x[0]] * n1 / n0, x[0]))[:20]}
    fine = sorted(w for w in clean if len(w) > 1)
    near: set[str] = set()
    sure, model = set(blamed), None
    for _ in range(rounds):
        bad = sorted(blamed)
        few = [fine[k] for k in rng.permutation(len(fine))[:6000]] if fine else []
        good = sorted((set(few) | near) - blamed)
        heavy = sorted(bad, key=lambda w: (-toxic[w], w))
        first = heavy[: landmarks // 3]
        rest = [bad[k] for k in rng.permutation(len(bad))[: landmarks // 3]]
        other = sorted(near)[: landmarks // 6] + [good[k] for k in rng.permutation(len(good))[: landmarks // 6]]
        marks = sorted(set(first) | set(rest) | set(other))
        value, vec = np.linalg.eigh(_kernel(marks, marks))
        ok = value > 1e-8
        root = vec[:, ok] / np.sqrt(value[ok])  # Nystroem map: kernel row @ root
        x = _kernel(bad + good, marks) @ root
        y = np.array([1.0] * len(bad) + [-1.0] * len(good))
        share = np.where(y > 0, 0.5 / max(len(bad), 1), 0.5 / max(len(good), 1))
        beta, bias = _svm(x, y, share)
        alpha = root @ beta
        w, code, v = subsequences(marks)
        model = Model(np.bincount(code, v * alpha[w], minlength=1 << TABLE_BITS), bias, 1.0, 0.0)
        margin = dict(zip(fine, model.margins(fine), strict=True)) if fine else {}
        near |= set(sorted((f for f in fine if margin[f] > -0.5), key=lambda f: (-margin[f], f))[:4000])
        blamed = set(sure)
        for ws, label in train:
            if label and not sure & ws:
                plain = sorted(p for p in ws if len(p) > 1 and not clean[p])
                if plain:
                    m = model.margins(plain)
                    if m.max() > 0.3:
                        blamed.add(plain[int(m.argmax())])
    model.weight = model.weight.astype(np.float32)
    scorer = Scorer(model)
    z = np.array([m for m, _ in scorer.worst([t for t, _ in back])])
    y = np.array([float(label) for _, label in back])
    model.slope, model.offset = _platt(z, y)
    model.offset += log_odds - np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the margins, by Newton steps with a weak prior."""
    if y.min() == y.max():
        return 1.0, 0.0
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))  # softened targets
    x = np.stack([z, np.ones_like(z)], axis=1)
    w = np.array([2.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (p - t) + 1e-3 * (w - [2.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(max(w[0], 0.1)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, keep: Column, per_class: int = 1500) -> tuple[Model | None, float]:
    """Fit on at most ``per_class`` documents of either label; also the log odds of the label."""
    odds = class_log_odds(labels, "toxic", keep)
    return fit(labelled_sample(docs, labels, "toxic", keep, per_class), odds), odds


def score(docs: DataFrame, model: Model | None, odds: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, margin, worst) for every row: probability, and the word that is to blame."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^20 numbers
    base = float(1 / (1 + np.exp(-odds)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m) if m is not None else None
        for b in batches:
            texts = texts_of(b)
            for lo in range(0, len(texts), 256):
                part = texts[lo : lo + 256]
                found = scorer.worst(part) if scorer else [(0.0, "")] * len(part)
                z = np.array([f[0] for f in found])
                p = 1 / (1 + np.exp(-np.clip(m.slope * z + m.offset, -40, 40))) if m is not None else np.full(len(z), base)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, len(part)), pa.array(p), pa.array(z), pa.array([f[1] for f in found], pa.string())],
                    ["id", "score", "margin", "worst"],
                )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, "id long, score double, margin double, worst string")


def keep_clean(docs: DataFrame, model: Model | None, odds: float, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose probability is ``limit`` or more; without a model, all rows."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cut = (np.log(limit / (1 - limit)) - model.offset) / model.slope

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts = texts_of(b, text_col)
            keep = [z < cut for lo in range(0, len(texts), 256) for z, _ in scorer.worst(texts[lo : lo + 256])]
            yield b.filter(pa.array(keep, pa.bool_()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(work, fields)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, odds = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score(docs, model, odds).select(
        F.col("id").alias("doc_id"),
        (fold("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "worst",
    )
