"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage works on all that its predecessor kept. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences. ``ORACLE_SQL`` is None, since
SQL can express none of the methods; tests hold the stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import decontaminate, packing, pii, simhash, toxicity
from lumenframe.llm.common import fold, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is 0.5 or more go; the classifier learns from the training fold."""
    model, odds = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, model, odds)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five words, Jaccard 0.8) stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or asked anew with other values, go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows the new text."""
    masked = pii.masked(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of at most 1024 ids."""
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate_benchmark),
    ("pii", mask_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
