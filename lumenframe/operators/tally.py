"""Counts per value, folded top lists, calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tally(df: DataFrame, values: Column, empty: str = "(none)") -> DataFrame:
    """(value, n): rows per entry of an array; a null or empty array counts as ``empty``."""
    some = F.when(F.coalesce(F.size(values), F.lit(0)) > 0, values).otherwise(F.array(F.lit(empty)))
    return df.select(F.explode(some).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def folded_top(counts: DataFrame, top: int) -> DataFrame:
    """(value, n, members): the values by count, then name; beyond ``top`` the rest is one row.

    The first values are an ordered limit, the rest is the sum of all less those; only ``top`` rows reach a window.
    """
    first = counts.orderBy(F.desc("n"), F.asc("value")).limit(top)
    first = first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("value"))))
    whole = counts.agg(F.count(F.lit(1)).alias("all"), F.sum("n").alias("sum"))  # one row
    named = first.join(F.broadcast(whole.select("all")), (F.col("all") <= top) | (F.col("rank") < top))
    kept = first.where(F.col("rank") < top).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))
    rest = whole.where(F.col("all") > top).join(F.broadcast(kept)).select(
        F.concat(F.lit("+ "), (F.col("all") - (top - 1)).cast("string"), F.lit(" more")).alias("value"),
        (F.col("sum") - F.col("kept")).alias("n"),
        (F.col("all") - (top - 1)).alias("members"),
    )
    return named.select("value", "n", F.lit(1).cast("long").alias("members")).unionByName(rest)


def by_level(df: DataFrame, level: DataFrame, on: str, group: Column, missing: str = "(not stated)") -> DataFrame:
    """(on, grp, n): counts per group in each value of a fixed list, which keeps values without rows."""
    n = df.groupBy(on, F.coalesce(group, F.lit(missing)).alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    return level.join(n, on, "left").select(on, F.coalesce("grp", F.lit("(none)")).alias("grp"), F.coalesce("n", F.lit(0)).alias("n"))


def daily(df: DataFrame, ts: Column, first: str, last: str) -> DataFrame:
    """(day, n) of every day from first to last; days without rows have 0, rows outside are dropped."""
    spark = df.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    n = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(n, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))
