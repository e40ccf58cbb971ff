"""Sequence packing: shortest pack first over the histogram of lengths.

Each document is encoded, closed with one id, and cut every ``size`` ids; whole pieces are
sequences of their own, and the last pieces (1 to ``size`` - 1 ids) are packed. Only the histogram of
their lengths, at most ``size`` numbers, reaches the driver. ``patterns`` places lengths longest first,
each into the shortest open pack, and counts how often each pattern of lengths occurs, so its work
depends on ``size`` and not on the number of documents. Patterns are joined back by rank: the k-th
piece of a length gets the k-th place of that length.

A task counts the pieces of each length as it cuts them; the counts of the tasks before it, summed
in a window over the counts alone, make that a rank over all pieces, so no piece is moved to be
ranked, however many have the same length.

Defined results: null text is the empty text and gives the closing id alone; a document's pieces
are told apart by their start; repeated rows are packed as often as they occur; a null id stays
null; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import table, texts_of, written
from lumenframe.llm.tokens import default_path, encoder


def pieces(docs: DataFrame, path: str, size: int = 1024, close: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, doc_tokens, crc, task, at, ids): the pieces of every document.

    ids: little-endian unsigned 32-bit integers; crc: their crc32; at: how many pieces of this length
    the task made before.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = int(close).to_bytes(4, "little")
        task = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in batches:
            keys, texts = batch.column("id"), texts_of(batch)
            for lo in range(0, len(texts), 512):
                row, start, length, total, crc, at, data = [], [], [], [], [], [], []
                for k in range(lo, min(len(texts), lo + 512)):
                    ids = enc.encode(texts[k]) + end
                    n = len(ids) // 4
                    for s in range(0, n, size):
                        part = ids[4 * s : 4 * (s + size)]
                        m = len(part) // 4
                        row.append(k)
                        start.append(s)
                        length.append(m)
                        total.append(n)
                        crc.append(zlib.crc32(part))
                        at.append(seen[m])
                        data.append(part)
                        seen[m] += 1
                numbers = (start, length, total, crc, [task] * len(row), at)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in numbers), pa.array(data, pa.binary())],
                    ["id", "start", "length", "doc_tokens", "crc", "task", "at", "ids"],
                )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(
        work, "id long, start long, length long, doc_tokens long, crc long, task long, at long, ids binary"
    )


def patterns(histogram: dict[int, int], size: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths (longest first) and how many sequences have each.

    Lengths go longest first into the shortest open pack (the one with the most room); when no
    open pack has room a new one is opened.
    """
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))  # by room
    rooms: list[int] = []  # heap of -room

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in open_ or not open_[room]:
            heapq.heappush(rooms, -room)
        open_[room][pattern] += n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while rooms and not open_.get(-rooms[0]):
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room >= length:
                pattern = next(iter(open_[room]))
                n = min(left, open_[room][pattern])
                open_[room][pattern] -= n
                if not open_[room][pattern]:
                    del open_[room][pattern]
                put(room - length, (*pattern, length), n)
                left -= n
            else:  # as if opened one by one: a new pack takes this length while it has room
                each = size // length
                n, rest = divmod(left, each)
                if n:
                    put(size - each * length, (length,) * each, n)
                if rest:
                    put(size - rest * length, (length,) * rest, 1)
                left = 0
    found: dict[tuple[int, ...], int] = defaultdict(int)
    for packs in open_.values():
        for pattern, n in packs.items():
            found[pattern] += n
    return sorted(found.items())


class Packed(NamedTuple):
    """places: (id, start, length, doc_tokens, crc, task, at, sequence_id, offset); pieces: with ids."""

    places: DataFrame
    pieces: DataFrame


def pack(docs: DataFrame, path: str | None = None, size: int = 1024, **knobs) -> Packed:
    """Pack ``docs`` into sequences of at most ``size`` ids."""
    cut = written(pieces(docs, path or default_path(), size, **knobs), "pieces")
    counts = written(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    base = counts.select("length", "task", before.alias("base"))
    whole = histogram.pop(size, 0)
    rows, used, first = [(size, 0, 0, 0)] if whole else [], defaultdict(int), whole
    for pattern, n in patterns(histogram, size):
        offset = 0
        for length in pattern:  # the next n pieces of this length, one in each of n sequences
            rows.append((length, used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    rows.sort()
    length_, from_, first_, offset_ = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 4
    key = (length_ << 44) + from_

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, at = (b.column(k).to_numpy() for k in ("length", "rank"))
            k = np.searchsorted(key, (length << 44) + at, side="right") - 1
            kept = [b.column(c) for c in names]
            more = [pa.array(first_[k] + at - from_[k], pa.int64()), pa.array(offset_[k], pa.int64())]
            yield pa.RecordBatch.from_arrays([*kept, *more], [*names, "sequence_id", "offset"])

    names = ["id", "start", "length", "doc_tokens", "crc", "task", "at"]
    light = cut.drop("ids").join(base, ["length", "task"])
    light = light.select(*names, (F.col("at") + F.col("base")).alias("rank"))
    schema = ", ".join(f"{c} long" for c in [*names, "sequence_id", "offset"])
    return Packed(light.mapInArrow(place, schema), cut)


def sequences(packed: Packed) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the sequences themselves, pieces by offset."""
    full = packed.places.join(packed.pieces.select("length", "task", "at", "ids"), ["length", "task", "at"])
    each = F.array_sort(F.collect_list(F.struct("offset", "id", "start", "ids")))  # at most size pieces
    return full.groupBy("sequence_id").agg(each.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.col("p.id").alias("doc_ids"),
        F.col("p.start").alias("starts"),
    )


def digest(packed: Packed) -> DataFrame:
    return packed.places.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
