"""Lattice hashing and SimHash against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from test_shingles import kept_by_brute_force

from lumenframe.llm import graph, lattice, simhash


def components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- components ----------------------------------------------------------------------------------


def test_components_of_chains_stars_and_nulls(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 180)] + [(500, k) for k in range(501, 560)] + [(7, 7), (3, 900), (900, 3)]
    edges += [(rng.randint(1000, 1060), rng.randint(1000, 1060)) for _ in range(40)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 4), (5, None)], "u long, v long")
    got = {r["node"]: r["root"] for r in graph.connected_components(df).collect()}
    want = components({n for e in edges for n in e}, edges)
    assert all(got.get(n, n) == r for n, r in want.items())
    assert graph.connected_components(df.limit(0)).count() == 0


# --- lattice -------------------------------------------------------------------------------------


def test_nearest_point_is_the_nearest_of_its_neighbourhood():
    x = np.random.default_rng(1).normal(0, 2, (400, 8))
    p = lattice.nearest_e8(x)
    assert np.all((2 * p == np.rint(2 * p)).all(axis=1))
    assert np.all(p.sum(axis=1) % 2 == 0)
    own = ((x - p) ** 2).sum(axis=1)
    for r in lattice.ROOTS:
        assert np.all(own <= ((x - p - r) ** 2).sum(axis=1) + 1e-9)
    assert own.max() <= 1 + 1e-9  # the covering radius of E8


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(25):
        centre = rng.normal(size=64)
        for _ in range(6):
            rows.append((centre + rng.normal(size=64) * rng.choice([0.1, 0.2, 0.28]), c % 3))
    out = [(k, v.astype(np.float32).astype(float).tolist(), label) for k, (v, label) in enumerate(rows)]
    out += [(1000 + k, out[0][1], 0) for k in range(30)]  # copies
    out += [(2000, out[0][1], 2), (2001, out[0][1], None), (2002, None, 0), (2003, [], 0), (2004, [0.0] * 64, 0)]
    out += [(2005, [float("nan")] * 64, 0), (2006, [1.0, None] + [0.0] * 62, 0), (2007, [float("inf")] + [0.0] * 63, 0), (2008, [1.0, 0.0], 0), (2009, [1.0, 0.0], 0)]
    return out


@pytest.mark.parametrize("tile", [512, 8])
def test_lattice_finds_every_link(spark, tile):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, node int")
    got = {r["id"]: (r["n_links"], r["component"]) for r in lattice.near_duplicates(df, tile=tile).collect()}
    ok = [
        (i, np.array(v), lab)
        for i, v, lab in rows
        if v and lab is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]
    pairs = []
    for k, (i, v, lab) in enumerate(ok):
        for j, w, other in ok[k + 1 :]:
            if lab == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                pairs.append((i, j))
    n = Counter(x for p in pairs for x in p)
    root = components([r[0] for r in rows], pairs)
    assert got == {r[0]: (n[r[0]], root[r[0]]) for r in rows}


def test_lattice_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert lattice.near_duplicates(df).count() == 0


# --- SimHash -------------------------------------------------------------------------------------


def plain_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", low)]
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize(
    "text", [None, "", "  ", "One", "a b", "a b c", "A\tb\x0bC\nd e", "x y z  w q", "a a a a a", "\x1c a\x1db c \x1f d", "É é Z z " * 40]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_pairs_are_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.repeat(base, 25)
    for k in range(len(fps)):
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            fps[k] ^= np.uint64(1) << np.uint64(b)
    got = {(int(a), int(b)) for x, y in simhash.sliced_pairs(fps, radius, lanes=128, queries=64) for a, b in zip(x, y, strict=True)}
    far = np.bitwise_count(fps[:, None] ^ fps[None, :])
    a, b = np.nonzero(np.triu(far <= radius, 1))
    assert got == set(zip(a.tolist(), b.tolist(), strict=True))


@pytest.mark.parametrize("block", [1024, 40])
def test_crowded_buckets_lose_no_link(spark, block):
    rng = np.random.default_rng(9)
    low = rng.choice(1 << 20, 300, replace=False).astype(np.uint64)  # 44 bits shared by all
    fps = np.unique(np.concatenate([low, low ^ np.uint64(1 << 3), low ^ np.uint64(3 << 40), np.zeros(1, np.uint64)]))
    df = spark.createDataFrame([(k, int(f.view(np.int64))) for k, f in enumerate(fps)], "node long, fp long")
    got = {r["node"]: r["root"] for r in graph.connected_components(simhash.link(df, 2, block)).collect()}
    far = np.bitwise_count(fps[:, None] ^ fps[None, :])
    a, b = np.nonzero(np.triu(far <= 2, 1))
    want = components(range(len(fps)), zip(a.tolist(), b.tolist(), strict=True))
    assert {n: got.get(n, n) for n in range(len(fps))} == want


def test_simhash_on_odd_rows(spark, odd_docs, odd_texts, no_docs):
    got = Counter((r["id"], r["fp"], r["component"]) for r in simhash.near_duplicates(odd_docs).collect())
    fp = [(i, plain_fingerprint(t)) for i, t in odd_texts]
    named = [(i, f) for i, f in fp if i is not None]
    pairs = [(i, j) for k, (i, f) in enumerate(named) for j, g in named[k + 1 :] if (f ^ g).bit_count() <= 2]
    root = components([i for i, _ in named], pairs)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == Counter((i, signed(f), root.get(i)) for i, f in fp)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == kept_by_brute_force(odd_texts)
    assert simhash.keep_one(no_docs).count() == 0


def test_different_texts_under_one_id_keep_their_links(spark):
    base = " ".join(f"w{k}" for k in range(300))
    other = " ".join(f"x{k}" for k in range(300))
    rows = [(2, base), (1, base + " end"), (3, other + " end"), (2, other), (2, other), (9, "alone here now")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, node string")
    got = {(r["id"], r["fp"]): r["component"] for r in simhash.near_duplicates(df).collect()}
    fp = {t: plain_fingerprint(t) for _, t in rows}
    near = lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2
    for i, t in rows:
        reach = {t}
        while more := {u for _, u in rows if u not in reach and any(near(u, r) for r in reach)}:
            reach |= more
        f = fp[t] - (1 << 64) if fp[t] >> 63 else fp[t]
        assert got[(i, f)] == min(j for j, u in rows if u in reach)


def test_different_vectors_under_one_id_keep_their_links(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=64), rng.normal(size=64)
    rows = [(1, a), (1, b), (2, a + 0.01), (3, b + 0.01), (None, a)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = Counter((r["id"], r["n_links"], r["component"]) for r in lattice.near_duplicates(df).collect())
    assert got == Counter([(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (None, 0, None)])


@pytest.mark.parametrize("dim", [8, 20, 768])
def test_lattice_recall_at_other_lengths(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(400, dim))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y
    k, m = (lattice.cell_keys(v, 4.0, 8, 20, 8) for v in (x, y))
    assert k.shape[1:] == (8, 20)
    met = [(np.isin(k[r], m[r])).any() for r in range(len(x))]
    assert np.mean(met) > 0.99


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_components_in_small_blocks(spark, block):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(50)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r["node"]: r["root"] for r in graph.connected_components(df, block=block).collect()}
    want = components({n for e in edges for n in e}, edges)
    assert {n: got.get(n, n) for n in want} == want
