"""Interaction audit of text filters: what each filter removes in every order of application.

Every document gets a mask of the filters that it fails; all figures follow from the counts of each
mask. Four filters look at a text alone and are expressions. The fifth, exact duplicates, is found by
partition refinement: documents are split by code-point length, then by the hash of one block after
another (256 bytes, then sixteen times as many each), and groups of one leave after every step, so that
only what may have a twin is looked at again. Full texts decide in the end: the survivors are grouped by
their text, and rows whose id is not the smallest of their text are marked.

Whole texts are scanned twice. The first scan keeps ids, masks and block hashes; the refinement runs on
those. The second lets through the texts whose hash is in a bitmap of the survivors, which is broadcast
(at most 2^27 bits), and groups them by text, combined before the shuffle, so a text with any number of
copies is one row a task. Steps between are joins on the group, where groups with a large share of the
rows are joined apart. The mask counts, 32 rows a part at most, are turned into all orders by one
expression a part. Two texts whose hashes agree in every block are told apart by the texts.

Defined results: a null text is the empty text; empty texts are equal; a null part is the empty string;
a null id never makes a row a duplicate and is no row's smaller id; rows that repeat an id with the same
text don't make each other duplicates; an id with several label rows counts as 1 if one of them is 1; no documents: no rows.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import discard, join_counted, table, written

#: The characters between words.
_SPACES = " \t\n\x0b\x0c\r"
DUPLICATE = "E"
_FIRST, _GROWTH, _BLOCKS = 256, 16, 7  # seven blocks are longer than any string
_METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The failure conditions of the four filters on one text and its words."""
    n = F.size(words).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": capitals * 100 > F.char_length(text).cast("long") * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def _start(k: int) -> int:
    return _FIRST * (_GROWTH**k - 1) // (_GROWTH - 1)


def block_hashes(text: Column, bits: int = 64) -> Column:
    """Hashes of the blocks of bytes that the text reaches into."""
    data, length = text.cast("binary"), F.octet_length(text)
    out = []
    for k in range(_BLOCKS):
        part = F.xxhash64(F.substring(data, _start(k) + 1, min(_FIRST * _GROWTH**k, (1 << 31) - 1)))
        out.append(F.when(length > _start(k), part if bits == 64 else part.bitwiseAND(F.lit((1 << bits) - 1))))
    return F.filter(F.array(*out), lambda h: h.isNotNull())


def _group(length: Column, blocks: Column, bits: int) -> Column:
    """The group of a text after its last block."""
    keep = lambda h: h if bits == 64 else h.bitwiseAND(F.lit((1 << bits) - 1))
    return F.aggregate(blocks, keep(F.xxhash64(length)), lambda acc, b: keep(F.xxhash64(acc, b)))


def refined(rows: DataFrame, bits: int = 64) -> list[DataFrame]:
    """The rows (..., len, blocks, n) that share their length and all their blocks with others, by number of blocks.

    Each table has ``key``, the group, in the place of what it was made of.
    """
    keep = lambda h: h if bits == 64 else h.bitwiseAND(F.lit((1 << bits) - 1))
    live = rows.withColumn("key", keep(F.xxhash64("len")))
    ended: list[DataFrame] = []
    before: DataFrame | None = None
    for step in range(_BLOCKS + 1):
        sizes = written(live.groupBy("key").agg(F.sum("n").alias("rows")).where("rows > 1"), "audit-groups")
        stay = written(join_counted(live, sizes, ["key"], "rows").drop("rows"), "audit-rows")
        discard(sizes)
        if before is not None:
            discard(before)
        before = stay
        ended.append(written(stay.where(F.size("blocks") == step).drop("len", "blocks"), "audit-ended"))
        rest = stay.where(F.size("blocks") > step)
        if rest.isEmpty():
            break
        live = rest.withColumn("key", keep(F.xxhash64("key", F.get("blocks", F.lit(step)))))
    discard(before)
    return ended


def _bitmap(keys: DataFrame, groups: int) -> tuple[DataFrame, int]:
    """(word, bits): one bit for each value of the lowest bits of the keys; at most 2^21 rows."""
    size = min(27, max(16, math.ceil(math.log2(8 * groups + 1))))
    low = F.col("key").bitwiseAND(F.lit((1 << size) - 1))
    bit = F.expr("shiftleft(1L, cast(key & 63 AS int))")
    return keys.select(F.shiftright(low, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")), size


def duplicates(texts: DataFrame, rows: DataFrame, bits: int = 64) -> DataFrame:
    """The rows of ``rows`` whose id is larger than another id with the same text.

    ``texts`` has (id, text, len, blocks, ...) for every document, ``rows`` the same without the texts, with
    equal rows as one and their number ``n``. Out: the columns of ``rows`` but len and blocks, and
    ``least``, the smallest id with the text.
    """
    ended = refined(rows, bits)
    survivors = ended[0]
    for more in ended[1:]:
        survivors = survivors.unionByName(more)
    keys = survivors.select("key").distinct()
    words, size = _bitmap(keys, keys.count())
    probe = texts.withColumn("key", _group(F.col("len"), F.col("blocks"), bits)).drop("len", "blocks")
    low = F.col("key").bitwiseAND(F.lit((1 << size) - 1))
    inside = (F.shiftright(low, 6) == F.col("word")) & (F.expr("shiftright(bits, cast(key & 63 AS int)) & 1") == 1)
    let_through = probe.select("id", "text", "key").join(F.broadcast(words), inside, "left_semi")
    by_text = let_through.groupBy("key", "text").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
    # one text for each group, unless hashes collide
    one = by_text.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("least").alias("least"), F.sum("rows").alias("rows"))
    one = written(one.where("rows > 1"), "audit-texts")
    later = F.col("id") > F.col("least")
    out = join_counted(survivors, one.where("kinds = 1").drop("kinds"), ["key"], "rows").where(later).drop("key", "rows")
    mixed = one.where("kinds > 1").select("key")
    if not mixed.isEmpty():
        known = by_text.join(mixed, "key", "left_semi").drop("rows")
        same = probe.join(mixed, "key", "left_semi").join(known, ["key", "text"]).where(later).drop("key", "text")
        out = out.unionByName(same.groupBy(*same.columns).agg(F.count(F.lit(1)).alias("n")))
    return out


def counted_masks(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str, bits: int = 64) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail; a bit for each filter, A the lowest."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    texts = narrow.withColumns(
        {"len": F.char_length("text").cast("long"), "blocks": block_hashes(F.col("text"), bits), "words": words_of(F.col("text"))}
    )
    filters = text_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    texts = texts.select("id", "part", mask.alias("mask"), "len", "blocks", "text")
    plain = texts.drop("text")
    plain = written(plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("n")), "audit-plain")
    twice = written(duplicates(texts, plain, bits).drop("least"), "audit-twice")
    moved = twice.withColumn("n", -F.col("n")).unionByName(twice.withColumn("mask", F.col("mask") + (1 << len(filters))))
    rows = plain.drop("len", "blocks").unionByName(moved)
    marks = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c) for c in ("quality", "toxic")])
        .where("quality = 1 OR toxic = 1")
    )
    # null ids have no labels; in the join they would all go to one task
    with_id = rows.where(F.col("id").isNotNull()).join(marks, "id", "left").drop("id")
    without = rows.where(F.col("id").isNull()).select("part", "mask", "n", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    labelled = with_id.unionByName(without)
    weight = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return labelled.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("quality").alias("good"), weight("toxic").alias("toxic"))


def all_orders(masks: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, ...): the figures of every step of every order, from the mask counts."""
    per_part = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    bit = {c: 1 << k for k, c in enumerate(letters)}
    steps = []
    for order in itertools.permutations(letters):
        before = 0
        for k, c in enumerate(order):
            steps.append({"filter_order": "".join(order), "step": k + 1, "own": bit[c], "before": before})
            before |= bit[c]
    literal = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>")
    rows = per_part.select("part", "masks", F.explode(literal).alias("s")).select("part", "masks", "s.*")
    own, before = F.col("own"), F.col("before")
    total = lambda value, fits: F.aggregate(
        F.filter("masks", lambda m: fits(m["mask"])), F.lit(0).cast("long"), lambda acc, m: acc + value(m)
    )
    fails = lambda m: m.bitwiseAND(own) != 0
    earlier = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~earlier(m)
    orders = math.factorial(len(letters))
    out = {
        "kept": total(lambda m: m["n"], lambda m: ~fails(m) & ~earlier(m)),
        "removed": total(lambda m: m["n"], here),
        "redundant": total(lambda m: m["n"], lambda m: fails(m) & earlier(m)),
        "unique_fails": total(lambda m: m["n"], lambda m: m == own),
        "good_lost": total(lambda m: m["good"], here),
        "toxic_lost": total(lambda m: m["toxic"], here),
        # a document falls to each filter that it fails in an equal share of all orders
        "shapley": total(lambda m: m["n"] * (F.lit(orders) / F.bit_count(m["mask"])).cast("long"), fails),
    }
    return rows.select("part", "filter_order", "step", *[out[c].alias(c) for c in _METRICS])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", bits: int = 64) -> DataFrame:
    """What each filter removes, by part, order and step."""
    letters = "".join(text_filters(F.lit(""), F.array())) + DUPLICATE
    return all_orders(counted_masks(docs, labels, id_col, text_col, part_col, bits), letters)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
f AS (SELECT doc_id, part,
  CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT f.*, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END AS good,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS bad FROM f),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM l GROUP BY part, mask),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
p AS (SELECT a.c || e.c || g.c || h.c || i.c AS filter_order, [a.bit, e.bit, g.bit, h.bit, i.bit] AS bits FROM b a, b e, b g, b h, b i
  WHERE len(list_distinct([a.c, e.c, g.c, h.c, i.c])) = 5),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (SELECT part, filter_order, step, own,
  sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost FROM m, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM x"""
