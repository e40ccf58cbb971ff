"""SimHash near-duplicates by bit-sliced comparison.

Two operators share the comparison: ``near_duplicates`` links fingerprints at a small radius,
``near_copies`` links texts by the similarity of their shingles of five words.

``fingerprints`` gives each text its 64-bit fingerprint, ``link`` groups fingerprints at a small
Hamming distance. Bit planes of a block of fingerprints are stored vertically (one machine word
holds one bit of 64 fingerprints); carry-save counters add the differing bits of 64 distances at
a time, and a block is abandoned once every distance in it exceeds the radius.

Which fingerprints meet in a block: two that differ in at most ``radius`` bits agree on one of
``radius + 1`` pieces of the bits, so each is dealt to one bucket per piece. A bucket over
``block`` fingerprints is dealt again by the pieces of its remaining bits, and again, until it is
small; buckets can't stay large, as distinct fingerprints that agree on all but k bits are at
most 2^k. So no pair within the radius is lost, whatever the skew, and no bucket is compared in
one piece. Only a spanning forest of each block leaves the task, never its pairs.

Defined results: null text is the empty text; no words: fingerprint zero, linked like any other;
rows whose id is null keep a fingerprint and have a null component; repeated rows with one id
come out as often as they came in, each linked by its own text. Other columns of the input are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import discard, join_counted, table, texts_of, written
from lumenframe.llm.graph import connected_components, local_roots
from lumenframe.llm.shingles import BANDS, band_keys, row_key, set_node, sets_of, shingle_hashes, shingles, verified

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def majority_bits(hashes: list[int] | np.ndarray) -> int:
    """64 bits, each 1 if over half the hashes have it."""
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint of one text, as an unsigned integer."""
    if not text.encode("utf-8").split():
        return 0
    return majority_bits(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, for every row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(fps.view(np.int64), pa.int64())], ["id", "fp"]
            )

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(work, "id long, fp long")


class _Counter:
    """Carry-save counter over words of lanes; ``above`` marks the lanes over the radius."""

    def __init__(self, shape: tuple[int, ...], radius: int):
        self.radius = radius
        self.bits = [np.zeros(shape, np.uint64) for _ in range(max(1, radius.bit_length()))]
        self.over = np.zeros(shape, np.uint64)

    def add(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        """Add three planes: a full adder makes a sum and a carry, which ripple on."""
        half = a ^ b
        carries = [(half ^ c, 0), ((a & b) | (half & c), 1)]
        for plane, k in carries:
            while k < len(self.bits):
                carry = self.bits[k] & plane
                self.bits[k] ^= plane
                plane, k = carry, k + 1
            self.over |= plane

    def above(self) -> np.ndarray:
        more = self.over.copy()
        same = ~self.over
        for k in range(len(self.bits) - 1, -1, -1):
            if self.radius >> k & 1:
                same &= self.bits[k]
            else:
                more |= same & self.bits[k]
                same &= ~self.bits[k]
        return more

    def keep(self, rows: np.ndarray) -> None:
        self.bits = [x[rows] for x in self.bits]
        self.over = self.over[rows]


def sliced_pairs(fps: np.ndarray, radius: int = 2, lanes: int = 512, queries: int = 256) -> Iterator[tuple]:
    """Index pairs i < j of ``fps`` (uint64) at Hamming distance <= radius, in pieces."""
    n = len(fps)
    wide = -(-n // lanes) * lanes
    padded = np.zeros(wide, np.uint64)
    padded[:n] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(wide, 8), axis=1, bitorder="little")
    packed = np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little"))
    planes = packed.view("<u8").reshape(64, wide // lanes, lanes // 64)
    lane = np.arange(wide)
    for first in range(0, n, queries):
        q = np.arange(first, min(n, first + queries))
        masks = np.where(bits[q].T.astype(bool), _ALL, np.uint64(0))  # 64 x queries
        blocks = np.arange(first // lanes, wide // lanes)
        row_q, row_b = (x.ravel() for x in np.meshgrid(np.arange(len(q)), blocks, indexing="ij"))
        later = (lane[None, :] > q[:, None]) & (lane[None, :] < n)
        packed = np.ascontiguousarray(np.packbits(later, axis=1, bitorder="little"))
        open_ = packed.view("<u8").reshape(len(q), wide // lanes, lanes // 64)
        live = open_[row_q, row_b]
        some = live.any(axis=1)
        row_q, row_b, live = row_q[some], row_b[some], live[some]
        count = _Counter(live.shape, radius)
        for p in range(0, 66, 3):
            if not len(row_q):
                break
            part = [
                planes[k][row_b] ^ masks[k][row_q][:, None] if k < 64 else np.zeros_like(live)
                for k in range(p, p + 3)
            ]
            count.add(*part)
            if p % 6 == 3 or p >= 63:
                near = live & ~count.above()
                on = near.any(axis=1)
                if not on.all():  # the rest of the blocks are abandoned
                    row_q, row_b, live, near = row_q[on], row_b[on], live[on], near[on]
                    count.keep(on)
        if len(row_q):
            hit = np.unpackbits(np.ascontiguousarray(near).view(np.uint8), axis=1, bitorder="little")
            r, c = np.nonzero(hit)
            yield q[row_q[r]], row_b[r] * lanes + c


def forest(fps: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smaller id) that join what is linked within one block, fewer than its size."""
    order = np.argsort(ids, kind="stable")
    fps, ids = fps[order], ids[order]
    root = np.arange(len(fps))
    for a, b in sliced_pairs(fps, radius):
        near = local_roots(len(fps), np.concatenate([a, np.arange(len(fps))]), np.concatenate([b, root]))
        root = near
    off = root != np.arange(len(fps))
    return ids[off], ids[root[off]]


def _pieces(mask: int, radius: int) -> list[int]:
    """The remaining bits of ``mask`` (those not fixed yet), in radius + 1 pieces."""
    rest = [b for b in range(64) if not mask >> b & 1]
    cuts = np.array_split(np.array(rest, dtype=int), radius + 1)
    return [sum(1 << int(b) for b in cut) for cut in cuts if len(cut)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link(points: DataFrame, radius: int = 2, block: int = 1024) -> DataFrame:
    """Edges (u, v) that connect the same nodes as all pairs at distance <= radius do.

    ``points`` has one row for each distinct fingerprint: (node, fp), both long.
    """
    spark = points.sparkSession
    edges: list[DataFrame] = []
    start = [_signed(m) for m in _pieces(0, radius)]
    rows = points.select("node", "fp", F.explode(F.array(*[F.lit(m) for m in start])).alias("mask"))
    masks = {m & (1 << 64) - 1 for m in start}
    while True:
        rows = written(rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "buckets")
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        sized = rows.join(sizes, ["mask", "key"])
        edges.append(written(_block_edges(sized.where(F.col("n") <= block), radius, block), "links"))
        hot = written(sized.where(F.col("n") > block).select("node", "fp", "mask"), "hot")
        discard(rows)
        if hot.isEmpty():
            break
        finer = {m: [m | p for p in _pieces(m, radius)] for m in masks}
        tree = [(_signed(m), _signed(c)) for m, cs in finer.items() for c in cs]
        masks = {c for cs in finer.values() for c in cs}
        below = spark.createDataFrame(tree, "mask long, child long")  # as long as the tree of pieces is wide
        rows = hot.join(F.broadcast(below), "mask").select("node", "fp", F.col("child").alias("mask"))
    out = edges[0]
    for more in edges[1:]:
        out = out.union(more)
    return out


def _block_edges(sized: DataFrame, radius: int, block: int) -> DataFrame:
    """Compare within each (mask, key); small buckets share a block, which only adds true links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            _, once = np.unique(rows[:, 0], return_index=True)
            rows = rows[once]
            u, v = forest(rows[:, 1].copy().view(np.uint64), rows[:, 0], radius)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("node", "fp", "mask", "key")]
            new = np.flatnonzero((np.diff(cols[2]) != 0) | (np.diff(cols[3]) != 0)) + 1
            rows = np.stack(cols[:2], axis=1)
            edge = [0, *new.tolist(), len(rows)]
            same = held and (last == (cols[2][0], cols[3][0]))
            for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
                if size >= block // 2 and not (k == 0 and same):
                    yield flush()
                    held, size = [], 0
                held.append(rows[lo:hi])
                size += hi - lo
            last = (cols[2][-1], cols[3][-1])
        if held:
            yield flush()

    dealt = sized.select("node", "fp", "mask", "key").repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(work, "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fp, component): for every row the smallest id reachable by links, itself included."""
    prints = written(fingerprints(docs, id_col, text_col, words), "prints")
    each = written(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "points")
    points = each.where(F.col("least").isNotNull()).withColumn("node", F.col("fp"))  # a fingerprint is its own node
    roots = connected_components(link(points.select("node", "fp"), radius))
    grouped = points.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component"))
    named = written(grouped.join(smallest, "root").select("fp", "component", "rows"), "named")
    out = join_counted(prints, named, ["fp"], "rows", "left")
    return out.select(
        F.col("id"), "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component")
    )


# --- near-copies at a similarity of 0.8 ------------------------------------------------------------


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, same, node, n, fp, bands) for every row: hashes of the text and of its set of shingles, the
    size and the fingerprint of the set, and the keys of the blocks it is compared in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in texts_of(b)]
            node, fps = (np.array([f(x) for x in found], np.uint64).view(np.int64) for f in (set_node, majority_bits))
            keys = np.concatenate([band_keys(x) for x in found]).view(np.int64) if found else np.zeros(0, np.int64)
            starts = pa.array(np.arange(0, len(keys) + 1, BANDS), pa.int32())
            sizes = pa.array([len(x) for x in found], pa.int64())
            bands = pa.ListArray.from_arrays(starts, pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("same"), pa.array(node, pa.int64()), sizes, pa.array(fps, pa.int64()), bands],
                ["id", "same", "node", "n", "fp", "bands"],
            )

    src = docs.select(*row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, "id long, same long, node long, n long, fp long, bands array<long>")


def closest_forest(comp: np.ndarray, a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) join the groups ``comp``, the closest pair of each group first."""
    chosen = [np.zeros(0, np.int64)]
    at = np.arange(len(a))
    while True:
        at = at[comp[a[at]] != comp[b[at]]]
        if not len(at):
            return np.concatenate(chosen)
        ca, cb = comp[a[at]], comp[b[at]]
        order = (far[at].astype(np.int64) << 40) + at
        best = np.full(len(comp), np.iinfo(np.int64).max)
        np.minimum.at(best, ca, order)
        np.minimum.at(best, cb, order)
        pick = np.unique(best[best < np.iinfo(np.int64).max]) & ((1 << 40) - 1)
        chosen.append(pick)
        comp = local_roots(len(comp), comp[a[pick]], comp[b[pick]])[comp]


def _shared(items: list[np.ndarray], x: np.ndarray, y: np.ndarray, columns: int = 1 << 16) -> np.ndarray:
    """How many members the sets x and y of each pair share: bits of the members that occur twice, and-ed."""
    who = np.unique(np.concatenate([x, y]))
    x, y = np.searchsorted(who, x), np.searchsorted(who, y)
    size = np.array([len(items[k]) for k in who])
    _, code, times = np.unique(np.concatenate([items[k] for k in who]), return_inverse=True, return_counts=True)
    common = np.cumsum(times > 1) - 1
    owner = np.repeat(np.arange(len(who)), size)
    keep = times[code] > 1
    owner, code = owner[keep], common[code[keep]]
    out = np.zeros(len(x), np.int64)
    for lo in range(0, int(code.max(initial=-1)) + 1, columns):
        part = (code >= lo) & (code < lo + columns)
        wide = -(-min(columns, int(code.max()) + 1 - lo) // 64) * 64
        held = np.zeros((len(who), wide), bool)
        held[owner[part], code[part] - lo] = True
        bits = np.packbits(held, axis=1).view(np.uint64)
        step = max(1, 2_000_000 // bits.shape[1])
        for k in range(0, len(x), step):
            out[k : k + step] += np.bitwise_count(bits[x[k : k + step]] & bits[y[k : k + step]]).sum(axis=1, dtype=np.int64)
    return out


def _joining(rows: DataFrame, radius: int, block: int) -> DataFrame:
    """(u, v): pairs of one block (key, lo, hi) at distance <= radius that join points of different roots,
    the closest pair of each group first, in all fewer than there are points.

    With a column ``items`` only pairs whose sets are at a similarity of 0.8 or more count.
    """
    names = ["key", "lo", "hi", "mine", "node", "root", "n", "fp"]
    exact = "items" in rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sets: list[np.ndarray] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            key, lo, hi, mine, node, root, n, fp = np.concatenate(held, axis=1)
            a, b, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
            fps = fp.copy().view(np.uint64)
            for x, y in sliced_pairs(fps, radius):
                ok = (key[x] == key[y]) & (lo[x] == lo[y]) & (hi[x] == hi[y]) & (root[x] != root[y])
                ok &= (lo[x] == hi[x]) | (mine[x] != mine[y])
                ok &= np.minimum(n[x], n[y]) * 5 >= np.maximum(n[x], n[y]) * 4
                x, y = x[ok], y[ok]
                if exact and len(x):
                    ok = _shared(sets, x, y) * 9 >= (n[x] + n[y]) * 4
                    x, y = x[ok], y[ok]
                a.append(x)
                b.append(y)
                far.append(np.bitwise_count(fps[x] ^ fps[y]))
            x, y, d = map(np.concatenate, (a, b, far))
            pick = closest_forest(np.unique(root, return_inverse=True)[1], x, y, d)
            u, v = node[x[pick]], node[y[pick]]
            return pa.RecordBatch.from_arrays([pa.array(f(u, v), pa.int64()) for f in (np.minimum, np.maximum)], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in names])
            found = batch.column("items") if exact else None
            cut = np.flatnonzero((np.diff(cols[:3], axis=1) != 0).any(axis=0)) + 1
            edge = [0, *cut.tolist(), cols.shape[1]]
            same = last is not None and np.array_equal(last, cols[:3, 0])
            for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
                if size >= block // 2 and not (k == 0 and same):
                    yield flush()
                    held, sets, size = [], [], 0
                held.append(cols[:, lo:hi])
                if exact:
                    sets += [found[r].values.to_numpy() for r in range(lo, hi)]
                size += hi - lo
            last = cols[:3, -1]
        if held:
            yield flush()

    columns = [*names, "items"] if exact else names
    dealt = rows.select(*columns).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(work, "u long, v long")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 24, block: int = 1024
) -> tuple[DataFrame, DataFrame]:
    """(id, same, node, n, fp, bands) of every row, and (node, root) of the sets that have a near-copy.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or
    more. Blocks of fingerprints are dealt by keys made of minima of the sets, as no cut of 64 bits can
    deal at a radius as wide as 0.8 needs: fingerprints of such a pair differ in 10 bits on average, with a
    spread of 3, and are compared up to ``radius``. What the comparison finds is verified by the sets,
    so nothing under 0.8 is linked; a pair at 0.8 is found with a computed chance over 0.9999.

    Two steps, each on the blocks that hold different groups. First the closest pairs that would join a block
    (fewer than its points) are verified by a join with the sets. Then the sets go to the blocks that still
    hold different groups, and all pairs of different groups are verified inside; only links that join groups
    leave a task, never its pairs. A block over ``block`` points is cut into tiles by a hash: the first step
    stays inside the tiles, the second takes each pair of tiles.
    """
    rows = written(_prints(docs, id_col, text_col), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "same", "n", "fp", "bands")).alias("f")
    points = written(rows.groupBy("node").agg(first).select("node", "f.id", "f.same", "f.n", "f.fp", "f.bands"), "points")
    dealt = points.select("node", "n", "fp", F.explode("bands").alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    buckets = written(dealt.join(shared, "key"), "buckets")
    met = points.join(buckets.select("node").distinct(), "node", "left_semi").select("id", "same")
    sets = written(sets_of(docs, met, id_col, text_col), "sets")
    discard(points)
    roots = buckets.select("node", F.col("node").alias("root")).limit(0)
    for step in ("closest", "all"):
        now = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = now.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
        now = written(now.join(parts.where(F.col("a") < F.col("b")).select("key"), "key"), "open")
        if now.isEmpty():
            discard(now)
            break
        tiles = F.ceil(F.col("m") / F.lit(block)).cast("int")
        dealt = now.withColumn("tiles", tiles).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        if step == "closest":
            dealt = dealt.withColumn("lo", F.col("mine")).withColumn("hi", F.col("mine"))
            found = verified(_joining(dealt, radius, block).distinct(), sets)
        else:
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            dealt = dealt.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
            found = _joining(dealt.join(sets, "node"), radius, block)
        links = written(found, "links")
        stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = written(connected_components(links.union(stars)), "roots")
        for old in (now, links):
            discard(old)
    discard(buckets)
    discard(sets)
    return rows, roots


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-copies: of each group the row with the smallest id stays.

    Rows are told apart by id and text together, so different texts under one id are judged each by
    itself and rows without an id by their text; a null id counts as the largest; of equal rows one
    stays. Null text is the empty text; texts without words are near-copies of each other.
    """
    rows, roots = near_copies(docs, id_col, text_col)
    named = rows.select("id", "same", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "same")).alias("f")
    own_id, own_text, kept_id, kept_text = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "text", "kept_id", "kept_text"))  # names that no table has
    kept = named.groupBy("root").agg(first).select(F.col("f.id").alias(kept_id), F.col("f.same").alias(kept_text))
    key, same = row_key(id_col, text_col)
    marked = docs.withColumn(own_text, same).withColumn(own_id, key)
    found = (F.col(own_text) == F.col(kept_text)) & F.col(own_id).eqNullSafe(F.col(kept_id))
    left = marked.join(kept, found, "left_semi")
    return left.dropDuplicates([own_id, own_text]).drop(own_id, own_text)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
