"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest

from lumenframe.llm import decontaminate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}


def kept_by_brute_force(rows):
    """Smallest row (null ids last) of each component at 0.8 or more, all pairs compared."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return Counter(rows[k] for k in set(root))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(3)
    rows, k = [], 0
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(40, 250))]
        for _ in range(6):
            k += 1
            rows.append((k, edited(rng, base, rng.randint(0, max(1, len(base) // 25)))))
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    return rows + [(1000 + n, edited(rng, base, 1 + n % 5)) for n in range(60)] + [(5000, None), (5001, " "), (5002, "one two")]


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA).repartition(3)
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    return Counter((r["doc_id"], r["text"]) for r in out.collect())


def test_stage_is_brute_force_jaccard(spark, near_copies):
    assert run(spark, near_copies) == kept_by_brute_force(near_copies)


def test_rows_are_judged_by_text_not_by_id(spark, near_copies):
    rng = random.Random(4)
    other = [" ".join(f"x{rng.randrange(5000)}" for _ in range(50)) for _ in range(6)]
    rows = [(7, other[0]), (7, other[1]), (7, other[1]), (8, other[1]), (6, other[0]), (None, other[2]), (None, other[3]), (9, other[3])]
    rows += [(1, other[5])]
    assert run(spark, rows) == kept_by_brute_force(rows)
    assert sum(run(spark, [(None, other[4]), (None, other[4] + " more")]).values()) == 1


def test_a_contaminated_text_takes_no_other_row_along(spark):
    item = "which planet of the solar system has the largest number of moons known to us today and why is that"
    clean = ["the river runs slowly past the old mill at the edge of town", "bread is baked before dawn in the small shop by the bridge"]
    held = "he asked " + item + " before he left the room"
    rows = [(None, held), (None, clean[0]), (3, held), (3, clean[1]), (None, None), (4, held)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.remove(docs, items)
    assert left.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter([(None, clean[0]), (3, clean[1]), (None, None)])


def test_large_group_of_copies_with_few_and_many_edits(spark):
    """Tiles and both steps: a group over several tiles, part of it too far from all others."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = [(k, edited(rng, base, rng.choice([1, 2, 4, 8, 14]))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    from lumenframe.llm import simhash

    found, roots = simhash.near_copies(docs, block=32)
    named = found.join(roots, "node", "left").selectExpr("id", "coalesce(root, node) root").collect()
    groups = {}
    for r in named:
        groups.setdefault(r["root"], set()).add(r["id"])
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    want = {}
    for k, r in enumerate(root):
        want.setdefault(r, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
