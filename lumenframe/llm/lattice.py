"""Embedding near-duplicates by lattice hashing.

Each vector is scaled to unit length and projected at random on 16 directions for each of ``tables``
tables, whatever its length; the two 8-dimensional halves are decoded to their nearest points of the
E8 lattice, and the pair of points is the table's cell. A vector is entered in its own cell of each
table and in the ``probes`` neighbouring cells whose walls are closest (joint order over both
halves); vectors that meet in a cell are compared by exact cosine.

At the default scale of 4 a pair at cosine 0.93, the loosest link, meets in one of the eight
tables with a measured chance over 0.999, while two unrelated vectors meet with one of 0.1 %.
``scale`` is the knob for size: doubling it makes cells 2^16 times smaller.

First only own cells are searched, and what is linked there is joined; then all entered cells that
still hold vectors of different groups. A search task returns a spanning forest of its links, fewer
rows than vectors, never its pairs. Links are then counted inside each component, where all of them
lie: a component is cut into tiles by a hash, each pair of tiles is one block product of a task, and
a task returns one number for each vector of its block. So no task gets a whole cell or component,
and no pair is ever a row. Equal vectors are one point with a count.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and
rows whose label is null, link with nothing and are their own component; vectors of different
lengths never link; different vectors with one vec_id are points of their own, each with its own
links, and share the id in components; a null id has no component and links with nothing. Other
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import discard, table, written
from lumenframe.llm.graph import connected_components, local_roots


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, from their rule."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(x < 0 for x in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    f = np.rint(x)
    e = x - f
    odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(e[odd]).argmax(axis=1)
    f[odd, worst] += np.where(e[odd, worst] >= 0, 1.0, -1.0)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row: of D8 or of D8 moved by one half."""
    a = _nearest_d8(x)
    b = _nearest_d8(x - 0.5) + 0.5
    near = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(near[:, None], a, b)


def _cells(x: np.ndarray, shell: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row its lattice point and the ``shell`` neighbours with the closest walls, each
    packed into one integer, and the distances to those walls (0 for its own)."""
    own = nearest_e8(x)
    wall = (2.0 - 2.0 * (x - own) @ ROOTS.T) / (2.0 * np.sqrt(2.0))
    some = np.argpartition(wall, shell, axis=1)[:, :shell]
    near = own[:, None, :] + ROOTS[some]
    points = np.concatenate([own[:, None, :], near], axis=1)
    packed = np.ascontiguousarray((2 * points).astype(np.int64).astype(np.int8)).view("<i8")[..., 0]
    far = np.concatenate([np.zeros((len(x), 1)), np.take_along_axis(wall, some, axis=1)], axis=1)
    return packed, far


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 2 + 1)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h + b.view(np.uint64)) * np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def cell_keys(unit: np.ndarray, scale: float, tables: int, probes: int, seed: int) -> np.ndarray:
    """(rows, tables, probes) cell keys; the first of a table is the vector's own cell."""
    n, dim = unit.shape
    wide = max(16, dim)
    x = np.zeros((n, wide))
    x[:, :dim] = unit
    shell = 15
    at_once = min(4, wide // 16)  # tables whose directions are orthogonal to each other
    out: list[np.ndarray] = []
    while len(out) < tables:
        r = len(out) // at_once
        turn, _ = np.linalg.qr(np.random.default_rng([seed, r, wide]).standard_normal((wide, 16 * at_once)))
        y = x @ turn * (scale * np.sqrt(wide / 64))
        for t in range(min(at_once, tables - len(out))):
            (ca, da), (cb, db) = (_cells(y[:, k : k + 8], shell) for k in (16 * t, 16 * t + 8))
            joint = (da[:, :, None] ** 2 + db[:, None, :] ** 2).reshape(n, -1)
            best = np.argsort(joint, axis=1, kind="stable")[:, :probes]
            i, j = best // (shell + 1), best % (shell + 1)
            out.append(
                _mix(np.take_along_axis(ca, i, 1), np.take_along_axis(cb, j, 1), r * 1000 + t)
            )
    return np.stack(out, axis=1)


def _vectors(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), dtype="<f8") for v in batch.column("vec")]


def _units(vecs: list[np.ndarray]) -> np.ndarray:
    x = np.array(vecs)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def points(rows: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """One row for each distinct comparable vector: node, id (the smallest), n, label, vec (bytes)."""
    packed = points_of_rows(rows, id_col, vec_col, label_col).where(F.col("vec").isNotNull())
    each = packed.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return written(each.withColumn("node", F.monotonically_increasing_id()), "points")


def entries(pts: DataFrame, scale: float, tables: int, probes: int, seed: int) -> DataFrame:
    """(node, key, own): the cells of every point, own marks the one it lies in."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = _vectors(b)
            nodes = b.column("node").to_numpy()
            salt = np.array([hash_label(x) for x in b.column("label").to_pylist()], dtype=np.int64)
            for dim in sorted({len(v) for v in vecs}):
                rows = np.array([k for k, v in enumerate(vecs) if len(v) == dim])
                for lo in range(0, len(rows), 1024):
                    part = rows[lo : lo + 1024]
                    keys = cell_keys(_units([vecs[k] for k in part]), scale, tables, probes, seed)
                    own = np.zeros(keys.shape, bool)
                    own[:, :, 0] = True
                    per = keys.shape[1] * keys.shape[2]
                    mixed = _mix(keys.reshape(-1), np.repeat(salt[part], per), dim)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(nodes[part], per), pa.int64()),
                            pa.array(mixed, pa.int64()),
                            pa.array(own.reshape(-1)),
                        ],
                        ["node", "key", "own"],
                    )

    return pts.select("node", "label", "vec").mapInArrow(enter, "node long, key long, own boolean")


def _dealt(rows: DataFrame, key: str, size: str, tile: int) -> DataFrame:
    """``rows`` with ``mine`` and one copy for each pair of tiles (lo, hi) of its group that it is in."""
    tiles = F.ceil(F.col(size) / F.lit(tile)).cast("int")
    mine = rows.withColumn("tiles", tiles).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    each = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    each = each.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    return each.drop("tiles", "other", size)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str], least: int) -> Iterator[list[tuple]]:
    """Rows (in the order of ``names``, which end in key, lo, hi) of whole blocks, small ones together."""
    held: list[tuple] = []
    last = None
    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in names), strict=True):
            if len(held) >= least and row[-3:] != last:
                yield held
                held = []
            held.append(row)
            last = row[-3:]
    if held:
        yield held


def _adjacent(rows: list[tuple], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, adjacency) for each vector length among rows (node, label, vec, ...)."""
    vecs = [np.frombuffer(r[2], dtype="<f8") for r in rows]
    label = np.unique([r[1] for r in rows], return_inverse=True)[1]
    dims = np.array([len(v) for v in vecs])
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        u = _units([vecs[k] for k in at])
        yield at, (u @ u.T >= threshold) & (label[at][:, None] == label[at][None, :])


def _forest(met: DataFrame, pts: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(u, v): links that join what the links among the rows (node, key, n) of one cell join."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["node", "label", "vec", "key", "lo", "hi"], 256):
            rows = list({r[0]: r for r in rows}.values())
            node = np.array([r[0] for r in rows], dtype=np.int64)
            for at, near in _adjacent(rows, threshold):
                root = local_roots(len(at), *np.nonzero(np.triu(near, 1)))
                off = root != np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[at[off]], pa.int64()), pa.array(node[at[root[off]]], pa.int64())], ["u", "v"]
                )

    full = _dealt(met, "key", "n", tile).join(pts.select("node", "label", "vec"), "node")
    dealt = full.select("node", "label", "vec", "key", "lo", "hi").repartition("key", "lo", "hi")
    return dealt.sortWithinPartitions("key", "lo", "hi").mapInArrow(search, "u long, v long")


def components(
    pts: DataFrame,
    threshold: float = 0.93,
    scale: float = 4.0,
    tables: int = 8,
    probes: int = 20,
    tile: int = 512,
    seed: int = 8,
) -> DataFrame:
    """(node, root) of the points that are linked with another point."""
    entered = written(entries(pts, scale, tables, probes, seed), "cells")
    own = entered.where("own").select("node", "key")
    shared = own.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    first = written(_forest(own.join(shared, "key"), pts, threshold, tile), "links")
    roots = written(connected_components(first), "roots")
    now = entered.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = now.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max("own").alias("lived"), F.min("root").alias("a"), F.max("root").alias("b")
    )
    open_ = open_.where(F.col("lived") & (F.col("a") < F.col("b"))).select("key", "n")
    second = written(_forest(entered.select("node", "key").join(open_, "key"), pts, threshold, tile), "links")
    discard(entered)
    out = connected_components(second.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    for old in (first, second):
        discard(old)
    return out


def count_links(pts: DataFrame, roots: DataFrame, threshold: float = 0.93, tile: int = 512) -> DataFrame:
    """(node, around): how many vectors, copies counted, are linked with a point of a component."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["node", "label", "vec", "n", "mine", "key", "lo", "hi"], 256):
            node = np.array([r[0] for r in rows], dtype=np.int64)
            copies, mine = (np.array([r[k] for r in rows], dtype=np.int64) for k in (3, 4))
            block = np.unique([r[5:] for r in rows], axis=0, return_inverse=True)[1].reshape(-1)
            across = np.array([r[6] != r[7] for r in rows])
            for at, near in _adjacent(rows, threshold):
                near &= block[at][:, None] == block[at][None, :]
                near &= ~across[at][:, None] | (mine[at][:, None] != mine[at][None, :])
                np.fill_diagonal(near, False)
                around = near.astype(np.float64) @ copies[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[at], pa.int64()), pa.array(around.astype(np.int64), pa.int64())], ["node", "around"]
                )

    sizes = roots.groupBy("root").agg((F.count(F.lit(1)) + 1).alias("size"))  # the root itself has no row
    members = roots.union(sizes.select(F.col("root").alias("node"), "root")).join(sizes, "root")
    members = members.select("node", F.col("root").alias("key"), "size")
    full = _dealt(members, "key", "size", tile).join(pts.select("node", "label", "vec", "n"), "node")
    dealt = full.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = dealt.select("node", "label", "vec", "n", "mine", "key", "lo", "hi").mapInArrow(count, "node long, around long")
    return found.groupBy("node").agg(F.sum("around").alias("around"))


def hash_label(label: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(label.encode(), 1)).view(np.int64))


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
    threshold: float = 0.93,
    tile: int = 512,
    **knobs,
) -> DataFrame:
    """(id, n_links, component) for every row: vectors linked directly, smallest id reachable."""
    pts = points(rows, id_col, vec_col, label_col)
    roots = written(components(pts, threshold, tile=tile, **knobs), "roots")
    around = count_links(pts, roots, threshold, tile)
    grouped = pts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("id").alias("component"))
    named = (
        grouped.join(around, "node", "left")
        .join(smallest, "root")
        .select("label", "vec", (F.col("n") - 1 + F.coalesce("around", F.lit(0))).alias("links"), "component")
    )
    members = points_of_rows(rows, id_col, vec_col, label_col).join(named, ["label", "vec"], "left")
    return members.select(
        "id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )


def points_of_rows(rows: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """Every row with the packed vector that ``points`` groups by; not comparable: null."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = []
            for v, label, key in zip(b.column("v").to_pylist(), b.column("label").to_pylist(), b.column("id").to_pylist(), strict=True):
                ok = v and label is not None and key is not None and all(x is not None for x in v)
                x = np.asarray(v, dtype="<f8") if ok else None
                ok = ok and bool(np.isfinite(x).all()) and bool((x != 0).any())
                data.append(x.tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array(data, pa.binary())], ["id", "label", "vec"]
            )

    src = rows.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(label_col).cast("string") if label_col else F.lit("")).alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
    )
    return src.mapInArrow(pack, "id long, label string, vec binary")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
