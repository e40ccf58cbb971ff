"""The filter audit, the conversation repair and the licence scan against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import oracle
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import filter_audit, licences, repair

# ---------------------------------------------------------------- filter audit

LABELS = "doc_id long, quality int, toxic int, n long, mask int"


def plain_masks(docs, labels):
    ids = defaultdict(list)
    for r in docs:
        if r["doc_id"] is not None:
            ids[r["text"] or ""].append(r["doc_id"])
    good = {r[0] for r in labels if r[1] == 1 and r[0] is not None}
    bad = {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    out = Counter()
    for r in docs:
        t, i = r["text"] or "", r["doc_id"]
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        capitals = sum("A" <= c <= "Z" for c in t)
        failed = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 2 * len(t), bool(re.search("[#$%&*|]", t))]
        failed.append(i is not None and min(ids[t]) < i)
        mask = sum(1 << k for k, f in enumerate(failed) if f)
        out[r["source"] or "", mask, "n"] += 1
        out[r["source"] or "", mask, "good"] += i in good and i is not None
        out[r["source"] or "", mask, "toxic"] += i in bad and i is not None
    return out


def plain_audit(docs, labels):
    masks = plain_masks(docs, labels)
    cells = {(p, m) for p, m, _ in masks}
    rows = set()
    for part in {p for p, _ in cells}:
        mine = {m: [masks[part, m, k] for k in ("n", "good", "toxic")] for p, m in cells if p == part}
        falls = Counter()
        table = []
        for order in itertools.permutations("ABCDE"):
            before = 0
            for step, c in enumerate(order, 1):
                own = 1 << "ABCDE".index(c)
                here = [v for m, v in mine.items() if m & own and not m & before]
                removed = sum(v[0] for v in here)
                falls[own] += removed
                kept = sum(v[0] for m, v in mine.items() if not m & (own | before))
                redundant = sum(v[0] for m, v in mine.items() if m & own and m & before)
                table.append((part, "".join(order), step, kept, removed, redundant, mine.get(own, [0])[0], sum(v[1] for v in here), sum(v[2] for v in here), own))
                before |= own
        rows |= {(*r[:-1], falls[r[-1]]) for r in table}
    return rows


def as_rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, k % 3 == 0, 0, 0) for k in range(1, 45)] + [(7, 0, 0, 0, 0), (None, 1, 1, 0, 0), (8, None, None, 0, 0)]
    return spark.createDataFrame([(a, b, None if c is None else int(c), d, e) for a, b, c, d, e in rows], LABELS)


def test_audit_is_that_of_a_plain_loop(odd_docs, labels):
    got = filter_audit.audit(odd_docs, labels)
    assert as_rows(got) == plain_audit(odd_docs.collect(), labels.collect())
    assert got.count() == 600 * odd_docs.select(F.coalesce("source", F.lit(""))).distinct().count()


@pytest.mark.parametrize("bits", [1, 3])
def test_texts_decide_where_hashes_collide(odd_docs, labels, bits):
    # with hashes of a few bits nearly all rows stay together to the end, repeated ids with other texts too
    assert as_rows(filter_audit.audit(odd_docs, labels, bits=bits)) == plain_audit(odd_docs.collect(), labels.collect())


def test_long_texts_that_differ_late(spark, labels):
    rng = random.Random(2)
    base = "".join(rng.choice("abc de") for _ in range(80_000))
    texts = [base, base, base[:-1] + "x", base[:300] + "x" + base[301:], base[:70_000] + "é" + base[70_001:], base]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    assert as_rows(filter_audit.audit(docs, labels)) == plain_audit(docs.collect(), labels.collect())


def test_one_text_holds_most_rows(spark, labels):
    rows = [(k, "copy", "s") for k in range(900)] + [(k, f"t{k}", "u") for k in range(900, 1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    assert as_rows(filter_audit.audit(docs, labels)) == plain_audit(docs.collect(), labels.collect())


def test_audit_of_no_documents(no_docs, labels):
    assert filter_audit.audit(no_docs, labels).count() == 0


def test_audit_is_that_of_sql(spark, medium):
    assert oracle.difference(filter_audit.op11_filter_audit(spark, medium), oracle.connect(medium), filter_audit.OP11_SQL) is None


# ---------------------------------------------------------------- conversation repair

TURNS = "conv_id long, turn long, role string, text string, fault string, signature string"


def plain_repair(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        turns = by[conv]
        role, text = (" " if v is None else v for v in (role, text))
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        turns += [(turn, "user" if pick == 4 else role, text)] * (2 if pick == 3 else 1)
    return {c: plain_one(sorted(t, key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))) for c, t in by.items()}


def plain_one(turns):
    seen, found = set(), []
    for _, role, text in turns:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    cost, audit, said = cheapest(turns, found)
    return gaps, *[found.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def cheapest(turns, found):
    """The least (cost, edits) by trying every edit of every turn, and every insertion."""
    grammar = re.compile("(s?(ua)+)?")
    best = None

    def go(k, cost, audit, said, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(turns) and grammar.fullmatch("".join(x[:1] for x in said)):
            mine = (cost, audit, said)
            best = mine if best is None or mine[:2] < best[:2] else best
        if inserted < 2:
            for role in ("user", "assistant"):
                go(k, cost + 2, audit + "I", [*said, f"{role}:"], inserted + 1)
        if k == len(turns):
            return
        _, role, text = turns[k]
        go(k + 1, cost + 3, audit + "D", said, 0)
        if found[k] in (None, "truncated"):
            cut = int(found[k] == "truncated")
            go(k + 1, cost + cut, audit + "K", [*said, f"{role}:{text}"], 0)
            for other in ("user", "assistant"):
                go(k + 1, cost + 2 + cut, audit + "R", [*said, f"{other}:{text}"], 0)

    best = (3 * len(turns), "D" * len(turns), [])
    go(0, 0, "", [], 0)
    return best


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(9)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "assistant", "user"], ["Yes.", "No", "", " \t", None, "Why?", "so. \n", "…", "a!", "éß."]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(150) for t in range(rng.randint(1, 5))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in (0, 1, 2)]
    rows += [(501, t, "user", "Hi.") for t in (None, None, 3, 3)] + [(502, 1, "s", "Hi."), (502, 9, "u", "Hm."), (502, 12, "a", "Ok.")]
    return spark.createDataFrame([(*r, "f", "s") for r in rows], TURNS).repartition(3)


def test_repairs_are_the_cheapest_of_all_edits(turns):
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damaged(turns)).collect()}
    assert got == plain_repair(turns.collect())


def test_all_signatures_against_all_edits(spark):
    texts = {"-": "", "c": "Done.", "t": "Done"}
    for size in (1, 2, 3, 4):
        for roles in itertools.product("suao", repeat=size):
            faults = random.Random("".join(roles)).choices([None, "truncated", "blank"], k=size)
            letters = "".join("-" if f == "blank" else r.upper() if f else r for r, f in zip(roles, faults, strict=True))
            layers = [repair.first_layer()]
            for mark in letters:
                layers.append(repair.next_layer(layers[-1], mark))
            want = cheapest([(None, r, texts["c"]) for r in roles], faults)
            assert repair.read_off(layers, letters) == want[:2], letters


def test_shared_prefixes_change_no_answer(spark):
    rng = random.Random(4)
    found = sorted({"".join(rng.choice("suaoSUAO-") for _ in range(rng.randint(0, 9))) for _ in range(400)})
    rows = spark.createDataFrame([(s,) for s in found] * 2, "signature string").repartition(5)
    got = {r["signature"]: (r["cost"], r["audit"], r["conversations"]) for r in repair.repairs(rows).collect()}
    for s in found:
        layers = [repair.first_layer()]
        for mark in s:
            layers.append(repair.next_layer(layers[-1], mark))
        assert got[s] == (*repair.read_off(layers, s), 2)


def test_a_long_conversation_and_many_alike(spark):
    long = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(30_000)]
    alike = [(c, t, "ua"[t] == "u" and "user" or "assistant", "Hi.") for c in range(100, 400) for t in (0, 1)]
    df = spark.createDataFrame([(*r, "f", "s") for r in long + alike], TURNS)
    got = {r["conv"]: r for r in repair.repair(repair.damaged(df)).collect()}
    assert len(got) == 301 and len(got[1]["audit"]) > 28_000
    short = [r for r in alike if r[0] < 130]
    want = plain_repair(short)
    assert all(tuple(got[c])[1:] == want[c] for c in want)


def test_no_conversations(spark, turns):
    assert repair.repair(repair.damaged(turns.limit(0))).count() == 0


def test_repair_is_that_of_sql(spark, medium):
    assert oracle.difference(repair.op12_repair(spark, medium), oracle.connect(medium), repair.OP12_SQL) is None


# ---------------------------------------------------------------- licence scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [w.encode() for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))]


def plain_scan(index, text):
    """Every template at every place of the whole text, without postings or pieces."""
    words = words_of(text)
    places, based, fits = [], set(), {}
    for phrase, label in index.base:
        for k in range(len(words)):
            if tuple(words[k : k + len(phrase)]) == phrase:
                places.append(k)
                based.add(label)
    for t in index.templates:
        for place in range(-len(t.words), len(words) + 1):
            share = index.share_at(t, place, words)
            if share >= index.share * (1 - 1e-9) and index.keys_at(t, place, words):
                fits[t.label] = max(fits.get(t.label, 0.0), share)
    score = 1.0 if based else max(fits.values(), default=0.0)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(based), sorted(based | fits.keys()), pytest.approx(score)


def licence_texts():
    rng = random.Random(3)
    rare = ["license", "mit", "apache", "the", "under", "cc", "by", "nc", "sa", "public", "general", "all", "rights", "reserved", "gnu", "x1", "ü", "permission"]
    out = [None, "", "\x00\x7f!", "CC-BY", "cc by cc by", "All rights   RESERVED", "ALL RIGHTS Reserved all rights reserved", "all right reserved"]
    for _, text, _ in licences.TEMPLATES:
        words = text.replace("*", "4").split()
        out.append(" ".join(words).upper())
        for _ in range(6):
            kept = [w for w in words if rng.random() > 0.15]
            at = rng.randrange(len(kept) + 1)
            out.append(" ".join(rng.choices(rare, k=7) + kept[:at] + rng.choices(rare, k=rng.randint(0, 3)) + kept[at:] + rng.choices(rare, k=7)))
    return out + [" ".join(rng.choices(rare, k=rng.randint(1, 60))) for _ in range(150)]


def test_scan_finds_what_every_place_gives():
    seen = {w: k * 7 % 40 for k, w in enumerate(sorted(licences.vocabulary()))}
    index = licences.Index(seen, 60)
    for text in licence_texts():
        want = plain_scan(index, text)
        assert index.scan(text or "") == want, text
        assert index.scan(text or "", piece=40) == want, text


def test_anchors_are_few_and_rarest():
    seen = dict.fromkeys(licences.vocabulary(), 1000) | {b"the": 90_000, b"mit": 3}
    index = licences.Index(seen, 100_000)
    short = index.templates[0]
    assert b"mit" in {short.words[k] for k in short.anchors} and b"the" not in {short.words[k] for k in short.anchors}
    for t in index.templates:
        assert sum(t.weights[k] for k in range(len(t.words)) if k not in t.anchors) < licences.SHARE


def test_licences_of_odd_documents(spark, odd_docs):
    extra = spark.createDataFrame([(70 + k, t) for k, t in enumerate(licence_texts()[:40])], "doc_id long, text string")
    docs = odd_docs.unionByName(extra, allowMissingColumns=True)
    seen, n = licences.document_counts(docs, licences.vocabulary())
    rows = docs.collect()
    assert n == len(rows)
    assert seen == {w: c for w in licences.vocabulary() if (c := sum(w in words_of(r["text"]) for r in rows))}
    index = licences.Index(seen, n)
    cells = lambda r: (r[0], *r[1:5], r[5].split(",") if r[5] else [], r[6].split(",") if r[6] else [], r[7])
    got = Counter(str(cells(tuple(r))[:7]) for r in licences.scan(docs).collect())
    assert got == Counter(str((r["doc_id"], *index.scan(r["text"] or "")[:6])) for r in rows)


def test_licences_of_no_documents(no_docs):
    assert licences.scan(no_docs).count() == 0


def test_a_notice_across_pieces_of_a_long_text():
    notice = licences.TEMPLATES[3][1]
    text = "wort " * 209_710 + notice + " all rights reserved" + " wort" * 1000
    index = licences.Index({}, 10)
    n, places, first, last, based, labels, score = index.scan(text)
    assert (n, places, first, last) == (len(text.split()), 1, 209_710 + len(notice.split()), 209_710 + len(notice.split()))
    assert based == ["reserved"] and labels == ["mit", "reserved"] and score == 1.0
