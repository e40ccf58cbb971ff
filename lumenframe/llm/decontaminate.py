"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of signs; numbers become <num>, words that name a unit after a
number <unit>, and runs of words with a capital inside a sentence one <name>; the words replaced stay
with the window as the filling of its slot. Windows of five canonical words of the documents are joined
with those of the benchmark by hash, and windows of five words as they stand (in lower case) with
such windows. Matches on one diagonal (document position minus item position) are one alignment; it
must be consistent: within it, a filling of the item always meets the same filling of the document,
and two names never meet the same one. So questions asked anew with other numbers or names are found,
and prose that only has the shape of a question is not. (A copy word by word is found by its words as
they stand, whatever else lies on its diagonal.)

A document is contaminated by an item if a consistent alignment covers ``share`` of the item's
windows, or runs over ``run`` words without a gap. Canonical windows with fewer than ``literal`` words outside
slots say too little and don't count, on either side; items dense in numbers, in title case or in
capitals are found by their words as they stand. An item of three or four words is one window, looked
for anywhere in a document; one of fewer words contaminates only documents of just these words.

A window leaves its document only if a bit of its hash is set in a filter over the benchmark: one
array of 2^23 bits whatever the benchmark's size, so what is broadcast doesn't grow; the join behind
it is exact. It takes only the rarest windows of each item, as few as every alignment that counts must meet, so a
phrase that many items and documents share joins nothing; the other windows are compared where a rare one has met. All later steps are grouped by (document, item, kind, diagonal).

Defined results: null or empty texts have no window; null ids of documents are kept as null;
repeated rows of one id are one document; items without a counted window match nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import table, texts_of, written

SIZE, LITERAL = 5, 3
FILTER_BITS = 23
#: Units that may follow a number.
UNITS = frozenset(
    "mm cm m km inch inches ft feet yd mile miles mg g kg t lb lbs oz ml l s sec min h hr hour hours "
    "day days week weeks month months year years % percent usd eur dollars euros cents mph kmh "
    "hz khz mhz w kw j kj cal kcal v a n pa degrees".split()
)
#: Words that often begin a sentence and are no names, even with a capital.
OPENERS = frozenset(
    "a all an and are as at but by can could did do does each every find for from given had has have he how if in "
    "is it its let of on one or she so some suppose that the then there these they this to was we were what when "
    "where which while who why will with would you".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,/:]*(?:st|nd|rd|th|%)?")
_EDGE = ".,;:!?\"'()[]{}<>|*_-–—«»„“”‘’¿¡…"
_KEEP = 400_000
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"


class Canon:
    """Words of texts and their canonical forms; what a word is by itself is kept while it stays in memory."""

    def __init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self._ids: dict[str, int] = {}
        self.bare: list[str] = []  # in lower case
        self._hash = np.zeros(1 << 12, np.uint64)
        self._flags = np.zeros(1 << 12, np.uint8)

    def _learn(self, raws: list[str]) -> None:
        for raw in raws:
            if raw in self._ids:
                continue
            k = self._ids[raw] = len(self.bare)
            if k == len(self._hash):
                self._hash = np.concatenate([self._hash, np.zeros_like(self._hash)])
                self._flags = np.concatenate([self._flags, np.zeros_like(self._flags)])
            bare = raw.strip(_EDGE)
            number = bool(_NUMBER.fullmatch(bare))
            low = bare.lower()
            self.bare.append(low)
            self._hash[k] = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 6)
            ends = raw[-1] in ".!?:|"
            self._flags[k] = bool(bare) | number << 1 | (not number and bare[:1].isupper() and low not in OPENERS) << 2 | (low in UNITS) << 3 | ends << 4

    def of(self, text: str) -> Words:
        if len(self._ids) > _KEEP:
            self._reset()
        raws, line = [], []
        for part in text.split("\n"):
            line.append(len(raws))
            raws += part.split()
        try:
            ids = np.fromiter(map(self._ids.__getitem__, raws), np.int64, len(raws))
        except KeyError:
            self._learn(raws)
            ids = np.fromiter(map(self._ids.__getitem__, raws), np.int64, len(raws))
        flags = self._flags[ids]
        starts = np.zeros(len(raws) + 1, np.int64)  # lines and sentences that begin before a word
        np.add.at(starts, line, 1)
        starts = np.cumsum(starts)[:-1] + np.concatenate([[0], np.cumsum(flags >> 4 & 1)[:-1]])
        kept = np.flatnonzero(flags & 1)
        ids, flags, starts = ids[kept], flags[kept], starts[kept]
        opening = np.diff(starts, prepend=-1) > 0
        number = (flags & 2) > 0
        name = ((flags & 4) > 0) & ~opening
        unit = ((flags & 8) > 0) & ~name & ~number & np.concatenate([[False], number[:-1]])
        first = np.flatnonzero(~(name & np.concatenate([[False], name[:-1]])))
        plain = self._hash[ids]
        canon = np.where(name, _NAME_HASH, np.where(number, _NUM_HASH, np.where(unit, _UNIT_HASH, plain)))[first]
        return Words(ids, plain, first, canon, (name | number | unit)[first])


@dataclass
class Words:
    ids: np.ndarray  # of the words, in Canon.bare
    plain: np.ndarray  # hash of each word
    first: np.ndarray  # first word of each canonical word
    canon: np.ndarray  # hash of each canonical word
    slots: np.ndarray  # whether it is a slot

    def filling(self, k: int, bare: list[str]) -> str:
        end = self.first[k + 1] if k + 1 < len(self.first) else len(self.ids)
        return " ".join(bare[i] for i in self.ids[self.first[k] : end])


_NUM_HASH, _UNIT_HASH, _NAME_HASH = (np.uint64(xxhash.xxh64_intdigest(x.encode(), 6)) for x in (NUM, UNIT, NAME))
TEMPLATE, AS_IT_STANDS = 0, 1


def windows(words: np.ndarray, size: int, kind: int, slots: np.ndarray | None = None, literal: int = LITERAL) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the counted windows of ``size`` words."""
    n = len(words)
    if not size or n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n - size + 1, kind, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[k : n - size + 1 + k]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(size)
    at = np.arange(len(h))
    if slots is not None:
        total = np.concatenate([[0], np.cumsum(slots)])
        at = at[size - (total[size:] - total[:-size]) >= min(literal, size)]
    return at, h[at]


def _sizes(n: int, short: tuple[int, ...]) -> set[int]:
    """Sizes of the windows of a document of n words: five, those of short items, and all of fewer than three."""
    return {size for size in (SIZE, *short) if size <= n} | ({n} if n < 3 else set())


def _rows_of(words: Words, sizes: tuple[set[int], set[int]], bare: list[str], passes=None) -> Iterator[tuple]:
    """(kind, size, pos, hash, fills) of the counted windows that ``passes`` lets through."""
    for kind, seq, slots in ((TEMPLATE, words.canon, words.slots), (AS_IT_STANDS, words.plain, None)):
        for size in sizes[kind]:
            at, h = windows(seq, size, kind, slots)
            if passes is not None:
                ok = passes(h)
                at, h = at[ok], h[ok]
            for p, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                fills = None
                if slots is not None and slots[p : p + size].any():
                    fills = [words.filling(p + k, bare) if slots[p + k] else None for k in range(size)]
                yield kind, size, p, x, fills


_SCHEMA = "id long, kind int, size int, pos long, hash long, fills array<string>"
_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_TYPES)
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names)


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The windows of the items; an item shorter than a window is one of its own size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon()
        for b in batches:
            rows = []
            for i, t in zip(b.column("id").to_pylist(), texts_of(b), strict=True):
                words = canon.of(t)
                sizes = tuple({min(SIZE, len(x))} for x in (words.canon, words.plain))
                rows += [(i, *r) for r in _rows_of(words, sizes, canon.bare)]
            yield _batch(rows)

    src = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, _SCHEMA)


def hash_filter(items: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit for each of 2^bits values of the lowest bits of the hashes that occur."""
    low = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = items.select((F.shiftright(low, 6)).alias("w"), low.bitwiseAND(F.lit(63)).alias("b"))
    rows = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("bits")).collect()  # 2^bits / 64 at most
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows:
        out[r["w"]] = r["bits"]
    return out.view(np.uint64)


def document_windows(docs: DataFrame, passes: np.ndarray, short: tuple[int, ...], id_col: str, text_col: str) -> DataFrame:
    """The windows of the documents that the filter lets through; ``short``: sizes of short items."""
    shared = docs.sparkSession.sparkContext.broadcast(passes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon, bits = Canon(), shared.value
        mask = np.uint64(len(bits) * 64 - 1)

        def let_through(h: np.ndarray) -> np.ndarray:
            low = h & mask
            return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1

        for b in batches:
            rows = []
            for i, t in zip(b.column("id").to_pylist(), texts_of(b), strict=True):
                words = canon.of(t)
                sizes = (_sizes(len(words.canon), short), _sizes(len(words.plain), short))
                rows += [(i, *r) for r in _rows_of(words, sizes, canon.bare, let_through)]
                if len(rows) > 10_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, _SCHEMA)


def rarest(bench: DataFrame, share: float, run: int) -> DataFrame:
    """(item_id, kind, at, hash) of the windows of which every alignment that counts has at least one.

    Windows are ranked by how many items hold them. An alignment over ceil(``share`` n) of an item's n windows has one
    of any n - ceil(share n) + 1 of them, so of that many rarest ones; one that runs over ``run`` words has
    every window of a row of run - SIZE + 1, so the rarest of it.
    """
    held = bench.groupBy("hash").agg(F.count_distinct("id").alias("held"))
    one = bench.select(F.col("id").alias("item_id"), "kind", F.col("pos").alias("at"), "hash").distinct().join(held, "hash")
    item = Window.partitionBy("item_id", "kind")
    rank = F.struct("held", "at")
    row = max(run - SIZE + 1, 1)
    ahead = item.orderBy("at").rowsBetween(0, row - 1)
    marked = one.select(
        "item_id", "kind", "at", "hash",
        F.row_number().over(item.orderBy("held", "at")).alias("nth"),
        F.count(F.lit(1)).over(item).alias("n"),
        F.size(F.collect_set("at").over(item)).alias("places"),  # of one item
        F.when(F.max("at").over(ahead) - F.col("at") == row - 1, F.min(rank).over(ahead)["at"]).alias("least"),
    )
    # an id with several texts keeps all its windows
    needed = F.when(F.col("n") > F.col("places"), F.col("n")).otherwise(F.col("n") - F.ceil(F.col("n") * F.lit(share)) + 1)
    of_rows = marked.where("least IS NOT NULL").select("item_id", "kind", F.col("least").alias("at")).distinct()
    by_row = marked.join(of_rows, ["item_id", "kind", "at"], "left_semi")
    return marked.where(F.col("nth") <= needed).unionByName(by_row).select("item_id", "kind", "at", "hash").distinct()


def matches(seen: DataFrame, bench: DataFrame, anchors: DataFrame) -> DataFrame:
    """(id, item_id, kind, diagonal, at, fills, wanted): the windows in common of a document and an item on the
    diagonals where an anchor of the item meets the document. Others, stock phrases above all, join nothing."""
    place = (F.col("pos") - F.col("at")).alias("diagonal")
    lines = seen.select("id", "pos", "hash").join(anchors, "hash").select("id", "item_id", "kind", place).distinct()
    items = bench.select(F.col("id").alias("item_id"), "kind", F.col("pos").alias("at"), "hash", F.col("fills").alias("wanted"))
    wanted = lines.join(items, ["item_id", "kind"]).withColumn("pos", F.col("diagonal") + F.col("at")).alias("w")
    there = seen.select("id", "pos", "hash", "fills").distinct().alias("s")
    same = (F.col("s.hash") == F.col("w.hash")) & (F.col("s.pos") == F.col("w.pos")) & F.col("s.id").eqNullSafe(F.col("w.id"))
    return wanted.join(there, same).select("w.id", "w.item_id", "w.kind", "w.diagonal", "w.at", "s.fills", "w.wanted").distinct()


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.8,
    run: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, windows, item_windows, longest, first_word, last_word, changed_slots, kind): one row
    for each contaminated document and item, its best alignment. Words are counted as canonical ones in
    alignments of kind 0 (templates), as they stand in those of kind 1."""
    bench = written(item_windows(items, item_id_col, item_text_col).where(F.col("id").isNotNull()), "items")
    sizes = bench.groupBy(F.col("id").alias("item_id"), "kind").agg(
        F.count_distinct("pos").alias("item_windows"), F.max("size").alias("size")
    )
    short = bench.where(F.col("size").between(3, SIZE - 1)).select("size").distinct().collect()  # at most two sizes
    seen = written(document_windows(docs, hash_filter(bench), tuple(r["size"] for r in short), id_col, text_col), "seen")
    met = written(matches(seen, bench, rarest(bench, share, run)), "met")
    line = ["id", "item_id", "kind", "diagonal"]
    # windows in a row: the position less its rank is the same within a run
    rank = F.dense_rank().over(Window.partitionBy(*line).orderBy("at"))
    placed = met.select(*line, "at").withColumn("run", F.col("at") - rank)
    runs = placed.groupBy(*line, "run").agg(F.count_distinct("at").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    lines = runs.groupBy(*line).agg(
        F.sum("n").alias("windows"), F.max("n").alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    pairs = (
        met.where(F.col("wanted").isNotNull() & F.col("fills").isNotNull())
        .select(*line, F.explode(F.arrays_zip("wanted", "fills")).alias("p"))
        .select(*line, F.col("p.wanted").alias("w"), F.col("p.fills").alias("f"))
        .where(F.col("w").isNotNull())
        .distinct()
    )
    name = ~F.col("w").rlike("[0-9]")
    slots = pairs.groupBy(*line).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("w").alias("nw"),
        F.count_if(name).alias("names"),
        F.count_distinct(F.when(name, F.col("f"))).alias("nf"),
        F.count_if(F.col("w") != F.col("f")).alias("changed"),
    )
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in line]
    fits = F.col("s.n").isNull() | ((F.col("s.n") == F.col("s.nw")) & (F.col("s.names") == F.col("s.nf")))
    lines = lines.alias("l").join(slots.alias("s"), same, "left").where(fits).select(
        *[F.col(f"l.{k}").alias(k) for k in ("id", "item_id", "kind", "windows", "most")],
        (F.col("l.diagonal") + F.col("lo")).alias("first_word"),
        (F.col("l.diagonal") + F.col("hi")).alias("last"),
        F.coalesce("s.changed", F.lit(0)).alias("changed_slots"),
    )
    lines = lines.join(sizes, ["item_id", "kind"]).withColumns(
        {"longest": F.col("most") + F.col("size") - 1, "last_word": F.col("last") + F.col("size") - 1}
    )
    found = lines.where(
        (F.col("windows") >= F.ceil(F.col("item_windows") * F.lit(share))) | (F.col("longest") >= run)
    )
    best = F.max_by(
        F.struct("windows", "item_windows", "longest", "first_word", "last_word", "changed_slots", "kind"),
        F.struct("windows", "longest", "kind", -F.col("first_word")),
    )
    return found.groupBy("id", "item_id").agg(best.alias("b")).select("id", "item_id", "b.*")


def remove(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **knobs) -> DataFrame:
    """The documents that no item contaminates, each distinct text judged by itself, whatever its id.

    A text is named by its 64-bit hash; rows without a text stay.
    """
    text = F.col(text_col).cast("string")
    own, gone = (f"{n}_{uuid.uuid4().hex}" for n in ("own", "gone"))  # names that no table has
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(text, F.lit(""))))
    narrow = keyed.select(F.col(own).alias("id"), text.alias("text"))
    found = contaminated(narrow, items, id_col="id", text_col="text", **knobs).select(F.col("id").alias(gone)).distinct()
    return keyed.join(found, F.col(own) == F.col(gone), "left_anti").drop(own)


def op6_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
