"""Ranks over a whole table or its strata without a window over all of either."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, order: Column, ties: str, strata: Sequence[str] = (), buckets: int = 256) -> DataFrame:
    """``df`` with ``rank`` from 0 and ``total`` within each stratum, in the order of a number, then of ``ties``.

    Rows are cut into buckets at quantiles of the number, so a task sorts one bucket of a stratum; the
    buckets before it are summed over the table of their counts, a row for each bucket and stratum.
    Null numbers come first. Approximate cuts change the buckets' sizes, never a rank.
    """
    rows = df.withColumn("_order", order.cast("double"))
    cuts = sorted(set(rows.approxQuantile("_order", [k / buckets for k in range(1, buckets)], 0.1 / buckets)))
    bucket = F.lit(0)
    if cuts:
        at = F.aggregate(F.lit(cuts), F.lit(0), lambda n, c: n + F.when(F.col("_order") > c, 1).otherwise(0))
        bucket = F.when(F.col("_order").isNull(), F.lit(-1)).otherwise(at)
    rows = rows.withColumn("_bucket", bucket)
    by = [*strata, "_bucket"]
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    counts = counts.withColumn("total", F.sum("_n").over(whole))
    counts = counts.withColumn("_before", F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*by).orderBy("_order", ties)) - 1
    placed = rows.withColumn("_inside", inside).alias("r")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in by]
    out = placed.join(counts.alias("c"), same).select(
        *[F.col(f"r.`{c}`") for c in df.columns], (F.col("_before") + F.col("_inside")).alias("rank"), F.col("c.total").alias("total")
    )
    return out
