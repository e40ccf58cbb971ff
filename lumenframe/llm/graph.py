"""Connected components: stars within tasks, then rounds of joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import discard, written


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], int(row["h"] or 0)


def _stars(edges: DataFrame, tasks: int) -> DataFrame:
    """The same components with fewer edges: each task joins what its own edges connect into stars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([b.column(k).to_numpy() for k in ("u", "v")]) for b in batches if b.num_rows]
        if held:
            ids, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
            at = at.reshape(2, -1)
            root = local_roots(len(ids), at[0], at[1])
            off = root != np.arange(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[off], pa.int64()), pa.array(ids[root[off]], pa.int64())], ["u", "v"]
            )

    return edges.coalesce(tasks).mapInArrow(work, "u long, v long")


def connected_components(edges: DataFrame, max_rounds: int = 60, block: int = 1 << 20) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    ``edges`` has two long columns u and v. First every task turns its ``block`` edges into stars in
    its own memory; one task's worth of edges is finished then. More go on by alternating two star
    contractions, each one grouped minimum (combined before the shuffle) and one join, with the
    stars of the tasks between them, until the edge set stands still. Every round is written to the
    shared folder, so a lost executor costs one round at most. Nodes without an edge are not
    returned; null ends and self loops are dropped. No edges: no rows.
    """
    base = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    base = base.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now = written(base.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    seen = _state(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        tasks = -(-seen[0] // block)
        stars = written(_stars(now, tasks), "edges")
        discard(now)
        if tasks == 1:
            now = stars
            break
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = written(small, "edges")
        state = _state(after)
        discard(stars)
        now, done, seen = after, state == seen, state
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indices over the pairs (a, b), in memory."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root
