"""Sharding along a Hilbert curve.

Documents are ordered by the Hilbert index of four metadata dimensions, each quantised to
2^``bits`` steps: source, language, size and id. Runs of that order are cut into shards, so each
shard covers a small box of the dimensions and readers that filter on one of them skip files.

Equal texts take the dimensions of the one with the smallest id, and so lie next to each other on
the curve; only a cut can part them. The law is ``rows``: shard sizes in rows differ by one at
most. (Keeping all copies in one shard can't go with that when a group holds a third of all rows.)

Steps: categories by the rank of the value among all values, however many; numbers by approximate
quantiles. The global rank, of values as of rows, is
found by range partitioning (sampled splits), a sort of each partition and the partitions' counts;
only the counts, one number for each partition, reach the driver.

Defined results: null text has no bytes; null source, language or id are the lowest step; repeated
rows are separate rows; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import join_counted, table, written


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates (rows, dims)."""
    x = np.array(coords, dtype=np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations from the coarsest level down
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _category_step(df: DataFrame, col: str, bits: int) -> Column:
    """Rank of the value among all values, scaled to the whole range, so that few values part it coarsely.

    The values are ranked by range partitioning, however many there are; the least value of each
    step, 2^bits at most, comes back to make the expression.
    """
    values, n = ranked(df.select(col).where(F.col(col).isNotNull()).distinct(), [col])
    if not n:
        return F.lit(0)
    step = F.expr(f"shiftleft(rank, {bits}) div {n}L")
    least = values.groupBy(step.alias("step")).agg(F.min(col).alias("least")).orderBy(F.desc("step")).collect()
    out = F.when(F.col(col) >= least[0]["least"], least[0]["step"])
    for r in least[1:]:
        out = out.when(F.col(col) >= r["least"], r["step"])
    return F.coalesce(out, F.lit(0))


def _number_step(cuts: list[float], col: str) -> Column:
    out = F.lit(0)
    for c in sorted(set(cuts)):
        out = out + F.when(F.col(col) > F.lit(c), 1).otherwise(0)
    return out


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with a gapless ``rank`` from 0 in the order of the columns, and the number of rows."""
    spark = rows.sparkSession
    pid = F.spark_partition_id()
    at = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_rows.withColumn("_pid", pid).withColumn("_at", at), "ranked")
    counts = sorted((r["_pid"], r["n"]) for r in placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    if not starts:
        return placed.withColumn("rank", F.col("_at")).drop("_pid", "_at"), 0
    offsets = spark.createDataFrame(starts, "_pid int, _from long")  # a row for each partition
    out = placed.join(F.broadcast(offsets), "_pid").withColumn("rank", F.col("_from") + F.col("_at"))
    return out.drop("_pid", "_at", "_from"), total


def shard(
    docs: DataFrame,
    shards: int = 24,
    bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    carry: bool = False,
) -> DataFrame:
    """(id, size, crc, curve, shard, slot) for every row of ``docs``; with ``carry`` its columns too, as ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    kept = ["row"] if carry else []
    meta = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("same"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        *carried,
    )
    meta = written(meta, "meta")
    first = meta.groupBy("same", "crc", "size").agg(F.min(F.struct("id", "source", "lang")).alias("f"), F.count(F.lit(1)).alias("copies"))
    groups = first.select("same", "crc", "size", "copies", F.col("f.id").alias("first"), "f.source", "f.lang")
    groups = written(groups, "first")
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    by_size, by_id = groups.approxQuantile(["size", "first"], cuts, 0.001)
    source, lang = _category_step(groups, "source", bits), _category_step(groups, "lang", bits)

    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a, b, c, d], axis=1), bits))

    steps = [source.cast("int"), lang.cast("int"), _number_step(by_size, "size"), _number_step(by_id, "first")]
    groups = written(groups.select("same", "crc", "size", "copies", curve(*steps).alias("curve")), "groups")
    rows = join_counted(meta.select("id", "same", "crc", "size", *kept), groups, ["same", "crc", "size"], "copies").drop("copies")
    rows, total = ranked(rows, ["curve", "same", "crc", "size", "id"])
    place = F.expr(f"rank * {shards}L div {max(total, 1)}L")
    start = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return rows.withColumn("shard", place).withColumn("slot", F.col("rank") - start).select(
        "id", "size", "crc", "curve", F.col("shard").cast("int").alias("shard"), "slot", *kept
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", rows_a_file: int = 1_000_000, **knobs) -> None:
    """Write ``docs`` as one folder for each shard, rows in the order of the curve, files of one run of slots each.

    Every row is written at the place it was counted for, those without an id and repeated ones too.
    Columns named shard or slot are replaced.
    """
    placed = shard(docs, id_col=id_col, carry=True, **knobs)
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    full = placed.select(*own, "shard", "slot").withColumn("_file", F.expr(f"slot div {rows_a_file}L"))
    dealt = full.repartition("shard", "_file").sortWithinPartitions("shard", "slot").drop("_file")
    dealt.write.partitionBy("shard").parquet(path)


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
