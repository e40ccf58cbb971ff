"""Decontamination joined on rare windows against a join of all windows."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import decontaminate as dc
from lumenframe.llm import simhash
from lumenframe.llm.common import written

WORDS = [f"w{k}" for k in range(60)] + ["12", "7", "Anna", "Bob"]


def all_windows(texts):
    """(id, kind) -> {position: [(hash, fills, size)]} of every counted window, by the operator's own words."""
    canon, out = dc.Canon(), defaultdict(lambda: defaultdict(set))
    for i, t in texts:
        words = canon.of(t or "")
        sizes = tuple({min(dc.SIZE, len(x))} for x in (words.canon, words.plain))
        for kind, size, pos, h, fills in dc._rows_of(words, sizes, canon.bare):
            out[i, kind][pos].add((h, tuple(fills) if fills else None, size))
    return out


def by_all_windows(docs, items, share=0.8, run=13):
    """The pairs (document, item) that an alignment over all windows contaminates."""
    found = set()
    bench, seen = all_windows(items), all_windows(docs)
    for (item, kind), want in bench.items():
        for (doc, other), have in seen.items():
            if other != kind:
                continue
            lines = defaultdict(dict)
            for at, ws in want.items():
                for pos, hs in have.items():
                    for w in ws:
                        for h in hs:
                            if w[0] == h[0]:
                                lines[pos - at].setdefault(at, []).append((w, h))
            for hits in lines.values():
                ats = sorted(hits)
                longest, length = 0, 0
                for k, at in enumerate(ats):
                    length = length + 1 if k and ats[k - 1] == at - 1 else 1
                    longest = max(longest, length)
                size = max(w[2] for ws in want.values() for w in ws)
                pairs = {(a, b) for ps in hits.values() for w, h in ps if w[1] and h[1] for a, b in zip(w[1], h[1], strict=True) if a is not None}
                firsts, names = {a for a, _ in pairs}, [(a, b) for a, b in pairs if not any(c.isdigit() for c in a)]
                if len(pairs) != len(firsts) or len(names) != len({b for _, b in names}):
                    continue
                if len(ats) >= math.ceil(len(want) * share) or longest + size - 1 >= run:
                    found.add((doc, item))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_rare_windows_lose_nothing(spark, seed):
    rng = random.Random(seed)
    stock = "which of the following is true about".split()
    items, docs = [], []
    for k in range(40):
        body = rng.choices(WORDS, k=rng.choice([3, 4, 5, 6, 9, 14, 30]))
        items.append((k, " ".join(stock * rng.randint(0, 2) + body + stock[: rng.randint(0, 7)])))
    for k in range(60):
        words = rng.choices(WORDS, k=rng.randint(0, 12)) + stock
        if rng.random() < 0.8:
            source = items[rng.randrange(40)][1].split()
            cut = rng.randint(0, max(len(source) // 3, 1))
            part = source[cut:] if rng.random() < 0.5 else source
            part = [rng.choice(WORDS) if rng.random() < 0.03 else w for w in part]
            words = words + part + rng.choices(WORDS, k=3)
        docs.append((100 + k, " ".join(words)))
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["id"], r["item_id"]) for r in got.collect()} == by_all_windows(docs, items)


def test_a_stock_phrase_joins_nothing(spark):
    rng = random.Random(5)
    tail = lambda p: " ".join(p + "".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(8))
    items = [(k, f"Which of the following is true about {tail('q')}") for k in range(300)]
    docs = [(k, f"They ask which of the following is true about {tail('z')} and so on") for k in range(297)]
    docs += [(1000 + k, f"Here: {items[k][1]} yes") for k in range(3)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    bench = written(dc.item_windows(i, "item_id", "text"), "items")
    seen = written(dc.document_windows(d, dc.hash_filter(bench), (), "doc_id", "text"), "seen")
    assert seen.count() > 600  # the phrase gets through the filter
    assert dc.matches(seen, bench, dc.rarest(bench, 0.8, 13)).count() < 200
    assert {(r["id"], r["item_id"]) for r in dc.contaminated(d, i).collect()} == {(1000 + k, k) for k in range(3)}


def test_a_short_item_is_told_by_its_own_words(spark):
    docs = spark.createDataFrame([(1, "so we say alpha beta gamma here")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    r = dc.contaminated(docs, items).first()
    assert (r["longest"], r["first_word"], r["last_word"]) == (3, 3, 5)


def test_columns_of_any_name_stay(spark):
    names = ["_gone", "_kept_id", "_kept_text", "_text_hash", "_row_id", "id", "same", "node", "own", "gone"]
    text = " ".join(f"word{k}" for k in range(20))
    rows = spark.createDataFrame([(1, text), (2, text), (3, "what is the capital of the moon today friend"), (4, None)], "doc_id long, text string")
    rows = rows.withColumns({n: F.lit(n) for n in names})
    items = spark.createDataFrame([(5, "what is the capital of the moon today friend")], "item_id long, text string")
    left = dc.remove(rows, items)
    assert left.columns == rows.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 4]
    one = simhash.keep_one(rows)
    assert one.columns == rows.columns and sorted(r["doc_id"] for r in one.collect()) == [1, 3, 4]
