"""Helpers shared by the corpus operators: shared storage, holdout folds, batch mapping."""

from __future__ import annotations

import math
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session does not name one (unit tests on one machine) a temporary folder is
    created and set, so that every later call of the session uses the same place. On a cluster
    that would not be shared, so a missing setting is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="lumenframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: what an executor loses later is read again from the shared folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path  # for discard()
    return out


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``written`` that nothing reads any more."""
    path = getattr(df, "_shared_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``left`` with the one row of ``right`` for its keys, whatever share of the rows one key has.

    ``count`` is a column of ``right``: how many rows of ``left`` have the key. Keys with more than a
    thousandth of all rows, which are fewer than a thousand, are joined by broadcast, the others by
    shuffle, where none is then large. Both sides should be cheap to read twice.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    large = right.where(F.col(count) * 1000 > total)
    small = right.where(F.col(count) * 1000 <= total)
    first = left.join(F.broadcast(large), keys)
    rest = left.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(small, keys, how)
    return first.unionByName(rest)


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    keep: Column,
    per_class: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[str, int]]:
    """At most ``per_class`` training texts of each of the two label values, on the driver.

    The bound is on what a classifier is fitted on, nothing else. Rows are the first in the order of
    a hash of id and text, so the choice is the same whatever the partitioning, and equal rows count
    once. Ids labelled more than once, with different values, count once with the largest value. Only
    the chosen ids (bounded by the parameter) are broadcast; the documents are scanned once and not
    shuffled. Where an id has many texts, at most ``per_class`` texts of each value are taken in all.
    """
    marks = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull())
        .where(keep)
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    order = F.xxhash64("_id")
    chosen = None
    for value in (0, 1):
        part = marks.where(F.col("_y") == value).orderBy(order, "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(F.broadcast(chosen), "_id")
        .select("_id", "_text", "_y", F.xxhash64("_id", "_text").alias("_h"))
        .dropDuplicates(["_id", "_text"])
    )
    found = written(found, "labelled")  # the two ordered limits below send at most the bound each
    by = {y: found.where(F.col("_y") == y).orderBy("_h", "_id", "_text").limit(per_class).collect() for y in (0, 1)}
    discard(found)
    rows = sorted(by[0] + by[1], key=lambda r: (r["_id"], r["_text"]))
    return [(r["_text"], r["_y"]) for r in rows]


def class_log_odds(labels: DataFrame, label: str, keep: Column) -> float:
    """log(n1 / n0) of the label over all training rows, with one added to either count."""
    y = F.col(label).cast("int")
    row = labels.where(keep).agg(F.count_if(y == 1).alias("n1"), F.count_if(y == 0).alias("n0")).first()
    return math.log((row["n1"] + 1) / (row["n0"] + 1))


def temperature(logits, y):
    """The temperature that minimises the log loss on held-back rows: of ``softmax(logits / T)`` for one
    column a class, of the logistic curve for one logit a row."""
    import numpy as np

    best, best_t = None, 1.0
    for t in np.exp(np.linspace(np.log(0.02), np.log(20), 241)):
        if logits.ndim == 1:
            z = np.clip(logits / t, -60, 60)
            loss = np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y)
        else:
            z = logits / t
            z = z - z.max(1, keepdims=True)
            loss = np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y])
        if best is None or loss < best - 1e-12:
            best, best_t = loss, float(t)
    return best_t
