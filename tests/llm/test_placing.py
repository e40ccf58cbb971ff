"""Hilbert shards, packing and host reputation."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
import oracle
import pytest
from tokenizers import Tokenizer

from lumenframe.llm import hilbert, packing, reputation
from lumenframe.llm.tokens import default_path, encoder

# --- Hilbert curve -------------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert np.all(np.abs(np.diff(path, axis=0)).sum(axis=1) == 1)


def test_shards_of_odd_rows(spark, odd_docs, odd_texts, no_docs):
    rows = hilbert.shard(odd_docs).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd_texts)
    assert Counter((r["id"], r["size"], r["crc"]) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    curve = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert curve == sorted(curve)
    order = [r["crc"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    runs = [k for k, _ in itertools.groupby(order)]
    assert len(runs) == len(set(runs))  # equal texts lie together
    assert hilbert.shard(no_docs).count() == 0


def test_rows_lie_in_the_order_of_a_brute_force_curve(spark):
    """Steps and places of a small table, computed row by row."""
    rng = np.random.default_rng(1)
    rows = [(k, "x" * int(rng.integers(1, 400)) + str(k), f"l{k % 4}", f"s{k % 7}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = {r["id"]: r for r in hilbert.shard(df).collect()}
    cuts = lambda v: np.quantile(v, [k / 16 for k in range(1, 16)], method="inverted_cdf")
    size = np.array([len(t) + 8 for _, t, _, _ in rows])
    ids = np.arange(200)
    steps = np.stack([ids % 7 * 16 // 7, ids % 4 * 4, (size[:, None] > np.unique(cuts(size))).sum(1), (ids[:, None] > np.unique(cuts(ids))).sum(1)], axis=1)
    want = hilbert.hilbert_index(steps, 4)
    close = np.array([got[k]["curve"] for k in range(200)]) == want
    assert close.mean() > 0.9  # the quantiles are approximate
    order = sorted(range(200), key=lambda k: (got[k]["shard"], got[k]["slot"]))
    curve = [got[k]["curve"] for k in order]
    assert curve == sorted(curve)
    assert [got[k]["shard"] for k in order] == [k * 24 // 200 for k in range(200)]


def test_shards_prune(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    placed = hilbert.shard(docs).select("id", "shard").join(docs.selectExpr("doc_id as id", "source"), "id")
    sources = docs.select("source").distinct().count()
    per = placed.groupBy("shard").agg({"source": "approx_count_distinct"}).collect()
    assert np.mean([r[1] for r in per]) < sources / 2
    langs = docs.selectExpr("doc_id as id", "lang").join(hilbert.shard(docs).select("id", "shard"), "id")
    per = langs.groupBy("shard").agg({"lang": "approx_count_distinct"}).collect()
    assert np.mean([r[1] for r in per]) < 0.75 * docs.select("lang").distinct().count()


def test_written_shards_hold_every_row_once(spark, odd_docs, odd_texts, tmp_path):
    named = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    hilbert.write_shards(named, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter({(i, t): 1 for i, t in odd_texts if i is not None})


def test_written_shards_hold_rows_without_an_id_and_repeated_ones(spark, odd_docs, odd_texts, tmp_path):
    hilbert.write_shards(odd_docs, str(tmp_path / "out"), rows_a_file=2)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter(odd_texts)
    assert len({(r["shard"], r["slot"]) for r in back}) == len(odd_texts)


# --- packing -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text",
    ["", "a", " a", "a  b", "it's  he'll\n\nx", "tab\tand\r\nlines ", "naïve café Ünï", "漢字 🙂 ok", "<|endoftext|> x", "a\u00a0b", "1234567 890", "x" * 3000, "don't stop\n now " * 50, "\n", "a \n b", "é"],
)
def test_ids_are_those_of_the_vocabulary(text):
    whole = Tokenizer.from_file(default_path())
    ids = np.frombuffer(encoder(default_path()).encode(text), "<u4").tolist()
    assert ids == whole.encode(text, add_special_tokens=False).ids


def naive(histogram, size):
    """One piece after the other, longest first, each into the open pack with the most room."""
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            k = max(range(len(rooms)), key=rooms.__getitem__, default=None)
            if k is None or rooms[k] < length:
                rooms.append(size - length)
            else:
                rooms[k] -= length
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_patterns_place_all_pieces(seed):
    rng = np.random.default_rng(seed)
    size = 32
    histogram = {int(k): int(n) for k, n in zip(rng.permutation(np.arange(1, size))[:9], rng.integers(1, 60, 9), strict=True)}
    found = packing.patterns(histogram, size)
    placed = Counter()
    for pattern, n in found:
        assert sum(pattern) <= size
        for length in pattern:
            placed[length] += n
    assert placed == histogram
    assert abs(sum(n for _, n in found) - naive(histogram, size)) <= 0.05 * naive(histogram, size) + 1


@pytest.mark.parametrize("size", [1024, 64])
def test_packing_is_a_round_trip(spark, odd_docs, odd_texts, no_docs, size):
    packed = packing.pack(odd_docs, size=size)
    rows = packed.places.collect()
    whole = Tokenizer.from_file(default_path())
    ids = [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in odd_texts]
    want = Counter()
    for i, x in ids:
        for s in range(0, len(x), size):
            part = np.array(x[s : s + size], dtype="<u4").tobytes()
            want[(i, s, len(part) // 4, len(x), zlib.crc32(part))] += 1
    assert Counter((r["id"], r["start"], r["length"], r["doc_tokens"], r["crc"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by) == set(range(len(by)))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    total = sum(len(x) for _, x in ids)
    assert len(by) <= -(-total // size) * 1.1 + 2
    seqs = packing.sequences(packed).collect()
    assert sum(len(s["ids"]) for s in seqs) == 4 * total
    assert packing.pack(no_docs).places.count() == 0


# --- host reputation -----------------------------------------------------------------------------


def test_reputation_sql_on_tables(spark, medium):
    con = oracle.connect(medium)
    assert oracle.difference(reputation.op5_reputation(spark, medium), con, reputation.OP5_SQL) is None


def test_hosts_paths_and_rules(spark):
    urls = {
        1: None, 2: "", 3: "no scheme", 4: "https://A.Example.COM/en/70?x#y", 5: "https://a.example.com/en/9", 6: "http://x.net#/de/",
        7: "x://org/es/", 8: "http://notexample.com/en/7", 9: "//a/b", 10: "http://Example.net/de/8a", 11: "a://b://c/d", 12: "http://h\n/p\nq",
    }
    pages = spark.createDataFrame([(k, u, "z") for k, u in urls.items()], "page_id long, url string, host string")
    none = spark.createDataFrame([], "id long, bad int")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.judge(pages, none).collect()}
    assert got == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("a.example.com", "/en/70", "example.com/en/7", "allow"), 5: ("a.example.com", "/en/9", "com/en/", "block"),
        6: ("x.net", "", None, "allow"), 7: ("org", "/es/", "org/es/", "block"), 8: ("notexample.com", "/en/7", "com/en/", "block"),
        9: ("", "", None, "allow"), 10: ("example.net", "/de/8a", "example.net/de/8", "block"), 11: ("b:", "//c/d", None, "allow"),
        12: ("h\n", "/p\nq", None, "allow"),
    }
    assert reputation.judge(pages.limit(0), none).count() == 0


def test_each_rule_has_the_word_of_the_contract(spark):
    urls = {1: "http://a.com/en/1", 2: "http://a.example.com/en/71", 3: "http://a.net/de/1", 4: "http://a.example.net/de/81", 5: "http://a.org/es/1", 6: "http://a.example.net/de/7"}
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    bad = spark.createDataFrame([(3, 1), (6, 1)], "id long, bad int")
    got = {r["id"]: (r["rule"], r["verdict"]) for r in reputation.judge(pages, bad).collect()}
    assert got == {
        1: ("com/en/", "block"), 2: ("example.com/en/7", "allow"), 3: ("net/de/", "allow"), 4: ("example.net/de/8", "block"),
        5: ("org/es/", "block"), 6: ("net/de/", "allow"),
    }


def test_a_bad_host_is_blocked_and_a_new_one_takes_its_domain(spark):
    pages = [(k, f"http://bad.spam.biz/{k}") for k in range(40)] + [(100 + k, f"http://good.fine.info/{k}") for k in range(40)]
    pages += [(200, "http://new.spam.biz/"), (201, "http://other.fine.info/")]
    outcomes = [(k, 1) for k in range(30)] + [(100 + k, 0) for k in range(30)] + [(None, 1), (5, None), (5, 0)]
    got = {
        r["id"]: r["verdict"]
        for r in reputation.judge(
            spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "id long, bad int")
        ).collect()
    }
    assert all(got[k] == "block" for k in range(40))
    assert got[200] == "block"
    assert all(got[100 + k] == "allow" for k in range(40))
    assert got[201] == "allow"


@pytest.mark.parametrize(("a", "b"), [(0.2, 2.0), (1.0, 1.0), (3.0, 1.0), (1.5, 9.0), (5.0, 5.0), (40.0, 160.0), (900.0, 100.0), (2e5, 1e6)])
def test_bound_is_the_quantile_of_the_posterior(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    df = df.selectExpr("*", *[f"{sql} AS {k}" for k, sql in reputation.CUMULANTS.items()])
    got = df.selectExpr(f"{reputation.quantile(-1.645)} AS q").first()["q"]
    sd = np.sqrt(1 / a + 1 / b)
    t = np.log(a / b) + np.sinh(np.linspace(-9, 6, 400_001)) * sd * 0.2  # log odds
    log = a * t - (a + b) * np.logaddexp(0, t)
    f = np.exp(log - log.max())
    mass = np.concatenate([[0], np.cumsum((f[1:] + f[:-1]) / 2 * np.diff(t))])
    chance = np.interp(np.log(got / (1 - got)), t, mass / mass[-1])
    assert chance == pytest.approx(0.05, abs=0.01)


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "co.uk", "b.org", "x.y.b.org:8080", "me@b.org", "10.0.0.1", "10.0.0.1:80", "", "localhost"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select(*reputation.registered(df.host)).collect()]
    assert got == [
        ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("b.org", "org"), ("b.org", "org"), ("b.org", "org"), ("10.0.0.1", "(address)"),
        ("10.0.0.1", "(address)"), ("", ""), ("localhost", "localhost"),
    ]


def test_a_host_with_most_of_the_pages_and_pages_without_an_id(spark):
    pages = [(k if k % 3 else None, "http://www.big.com/x") for k in range(600)] + [(1000 + k, f"http://h{k}.com/") for k in range(50)]
    outcomes = [(k, 1) for k in range(0, 600, 5)] + [(1000 + k, 0) for k in range(50)]
    found = reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "id long, bad int")
    ).collect()
    assert Counter((r["id"], r["verdict"]) for r in found) == Counter((i, "block" if i is None or i < 1000 else "allow") for i, _ in pages)
    assert len({(r["n_outcomes"], r["bound"]) for r in found if r["host"] == "www.big.com"}) == 1


def test_many_values_of_a_category_keep_their_order(spark):
    from lumenframe.llm.hilbert import _category_step

    names = [f"host{k:05d}" for k in range(6000)] + ["é", "zz", ""]
    df = spark.createDataFrame([(n,) for n in names] + [(None,), ("zz",)], "source string").repartition(3)
    got = {r["source"]: r["step"] for r in df.select("source", _category_step(df, "source", 4).alias("step")).collect()}
    order = sorted(names)
    assert got == {n: k * 16 // len(order) for k, n in enumerate(order)} | {None: 0}
    few = df.where("source IN ('é', 'zz') OR source IS NULL")
    assert {r["source"]: r["step"] for r in few.select("source", _category_step(few, "source", 4).alias("step")).collect()} == {"é": 8, "zz": 0, None: 0}
    assert few.limit(0).select(_category_step(few.limit(0), "source", 4)).count() == 0
