"""Licence scan: a positional index of the rare words of licence notices.

Templates are the words of notices, ``*`` for a word that may be any, each with phrases that must stand
as they are. Over all documents the share that holds each template word gives its inverse document
frequency (IDF). A template fits at a place where the words found in their relative position, give or take
``SLACK`` words, carry ``SHARE`` of the IDF of its words, and where its key phrases stand inside. The index holds the
postings of each template's highest-IDF words only: as few as leave less than ``SHARE`` to the others. So every
place that fits has one of them, and a file is looked up by its rarest licence words; all other postings are
read only at the places these give. Three base phrases are labelled wherever they stand.

Both passes over the whole texts are maps; only the counts of the template words (a fixed vocabulary) are
grouped and pass through the driver. A text is read in pieces of about a megabyte that overlap by the
longest template, so memory follows the piece.

Defined results: a null text is empty; no word: no label, score 0. ``score`` is the largest share of a
template that fits, 1 where a base phrase stands. Documents without rows, repeated ids and rows: one row each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lumenframe.llm.common import table, texts_of

#: Phrases that always count, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Words of licence notices as their owners publish them: (label, words, key phrases).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "spdx license identifier mit", ("license identifier mit",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
        " the software to deal in the software without restriction including without limitation the rights to use copy modify merge",
        ("permission is hereby granted", "without restriction"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("source and binary forms", "conditions are met"),
    ),
    ("bsd", "licensed under the bsd license", ("bsd license",)),
    ("apache", "licensed under the apache license version * *", ("apache license",)),
    ("apache", "spdx license identifier apache * *", ("license identifier apache",)),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("in compliance with the license",),
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v * *", ("mozilla public license",)),
    ("gpl", "this work is licensed under the gnu general public license version *", ("general public license",)),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        ("gnu general public license",),
    ),
    ("gpl", "spdx license identifier gpl * *", ("license identifier gpl",)),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        ("lesser general public license",),
    ),
    (
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        ("affero general public license",),
    ),
    ("cc-by-nc", "licensed under cc by nc * *", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa * *", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd * *", ("cc by nd",)),
    ("cc-by", "licensed under cc by * *", ("cc by",)),
    ("cc-by", "this work is licensed under a creative commons attribution * * international license", ("creative commons attribution",)),
    (
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike * * international license",
        ("creative commons attribution sharealike",),
    ),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial * * international license",
        ("creative commons attribution noncommercial",),
    ),
    ("cc0", "dedicated to the public domain under cc0 * *", ("cc0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("public-domain", "this work has been released into the public domain by its author", ("public domain by",)),
)
SHARE, SLACK = 0.6, 2
_PIECE = 1 << 20
#: Words are runs of digits, a to z and everything outside ASCII, after A to Z have become small.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _words(text: str) -> tuple[bytes, ...]:
    return tuple(text.encode().split())


def pieces(text: str, overlap: int, piece: int = _PIECE) -> Iterator[tuple[list[bytes], int, int]]:
    """(words, number of words repeated from the piece before, place of the first word), piece by piece."""
    data = text.encode("utf-8", "surrogatepass").translate(_WORDS)
    at, before, tail = 0, 0, []
    while at < len(data):
        end = len(data) if at + piece >= len(data) else data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        words = tail + data[at:end].split()
        yield words, len(tail), before - len(tail)
        before += len(words) - len(tail)
        tail = words[-overlap:] if overlap else []
        at = end


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    weights: tuple[float, ...]
    anchors: tuple[int, ...]


class Index:
    """Templates with the weights of their words, and the postings of their rarest ones."""

    def __init__(self, seen: dict[bytes, int], documents: int, templates=TEMPLATES, share: float = SHARE, slack: int = SLACK):
        self.share, self.slack = share, slack
        self.base = [(_words(phrase), label) for phrase, label in BASE]
        self.templates: list[Template] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for label, text, keys in templates:
            words = _words(text)
            idf = [0.0 if w == b"*" else math.log(1 + (documents + 1) / (seen.get(w, 0) + 1)) for w in words]
            total, anchors, rest = sum(idf), [], sum(idf)
            for k in sorted(range(len(words)), key=lambda k: (-idf[k], k)):
                if rest < share * total * (1 - 1e-9):
                    break
                anchors.append(k)
                rest -= idf[k]
            weights = tuple(x / total for x in idf)
            for k in anchors:
                self.postings.setdefault(words[k], []).append((len(self.templates), k))
            self.templates.append(Template(label, words, tuple(_words(k) for k in keys), weights, tuple(anchors)))
        self.span = max([len(t.words) for t in self.templates] + [len(p) for p, _ in self.base]) + 2 * slack
        self.rare = frozenset(self.postings)
        self.first = frozenset(p[0] for p, _ in self.base)
        self.opens = frozenset(key[0] for t in self.templates for key in t.keys)

    def share_at(self, t: Template, place: int, words: list[bytes]) -> float:
        """The share of the template's weight that stands at its relative places from ``place``."""
        out = 0.0
        for k, (w, weight) in enumerate(zip(t.words, t.weights, strict=True)):
            if weight:
                lo = place + k - self.slack
                if w in words[max(lo, 0) : max(lo + 2 * self.slack + 1, 0)]:
                    out += weight
        return out

    def keys_at(self, t: Template, place: int, words: list[bytes]) -> bool:
        inside = words[max(place - self.slack, 0) : max(place + len(t.words) + self.slack, 0)]
        return all(any(tuple(inside[k : k + len(key)]) == key for k in range(len(inside) - len(key) + 1)) for key in t.keys)

    def scan(self, text: str, piece: int = _PIECE) -> tuple[int, int, int | None, int | None, list[str], list[str], float]:
        """(words, base places, first and last of them, base labels, all labels, score) of one text."""
        n, places, first, last = 0, 0, None, None
        based: set[str] = set()
        fits: dict[str, float] = {}
        for words, old, start in pieces(text, self.span, piece):
            n = start + len(words)
            held = set(words)
            at: dict[bytes, list[int]] = {}
            hit = not self.rare.isdisjoint(held)
            if hit or not self.first.isdisjoint(held):
                wanted = held & (self.rare | self.first | self.opens if hit else self.first)
                for k, w in enumerate(words):
                    if w in wanted:
                        at.setdefault(w, []).append(k)
            for phrase, label in self.base:
                size = len(phrase)
                for k in at.get(phrase[0], ()):
                    if k + size > old and tuple(words[k : k + size]) == phrase:
                        places += 1
                        here = start + k
                        first = here if first is None or here < first else first
                        last = here if last is None or here > last else last
                        based.add(label)
            tried: set[tuple[int, int]] = set()
            stands: dict[tuple[bytes, ...], bool] = {}
            for w in self.rare & at.keys():
                for number, k in self.postings[w]:
                    t = self.templates[number]
                    for key in t.keys:
                        if key not in stands:
                            stands[key] = any(tuple(words[p : p + len(key)]) == key for p in at.get(key[0], ()))
                    if not all(stands[key] for key in t.keys):
                        continue  # a key phrase is nowhere in this piece
                    for p in at[w]:
                        if fits.get(t.label, 0.0) > 1 - 1e-9:
                            break
                        for place in range(p - k - self.slack, p - k + self.slack + 1):
                            if (number, place) in tried:
                                continue
                            tried.add((number, place))
                            share = self.share_at(t, place, words)
                            if share >= self.share * (1 - 1e-9) and share > fits.get(t.label, 0.0) and self.keys_at(t, place, words):
                                fits[t.label] = share
        score = 1.0 if based else min(max(fits.values(), default=0.0), 1.0)
        return n, places, first, last, sorted(based), sorted(based | fits.keys()), score


def vocabulary(templates=TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for _, text, _ in templates for w in _words(text))


def document_counts(docs: DataFrame, wanted: Iterable[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """How many documents hold each wanted word, and how many there are."""
    words = frozenset(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for text in texts_of(b):
                seen[b""] += 1
                held: set[bytes] = set()
                for found, _, _ in pieces(text, 0):
                    held |= words.intersection(found)
                seen.update(held)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen]), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "word string, n long")
    found = {r["word"].encode(): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop(b"", 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """The licence labels of every document."""
    seen, documents = document_counts(docs, vocabulary(templates), text_col)
    index = Index(seen, documents, templates)
    shape = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = StructType([StructField(id_col, rows.schema[0].dataType), *StructType.fromDDL(shape)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, places, first, last, based, every, score = zip(*map(index.scan, texts_of(b, "_text")), strict=True)
            numbers = [pa.array(c, pa.int64()) for c in (n, places, first, last)]
            labels = [pa.array([",".join(x) for x in c], pa.string()) for c in (based, every)]
            yield pa.RecordBatch.from_arrays([b.column(0), *numbers, *labels, pa.array(score, pa.float64())], schema.names)

    return rows.mapInArrow(work, schema)


def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
