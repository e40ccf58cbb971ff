"""Run monitoring, queues and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def alerts(runs: DataFrame, cadence: DataFrame, now: Column, streak: int = 3, factor: float = 2, budget_h: float = 2) -> DataFrame:
    """(key): ``<routine>:none`` without runs; ``:stale`` when the last began too long ago; of the last
    ``streak`` runs ``:failing`` if all failed or never ended, else, for finders, ``:dry`` if none added.

    runs: (routine, started_at, status, added); cadence: (routine, hours, finds).
    """
    w = Window.partitionBy("routine").orderBy(F.desc("started_at"))
    last = runs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= streak)
    s = last.groupBy("routine").agg(
        F.max("started_at").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.col("status").isin("failed", "running")).alias("failing"),
        F.bool_and(F.coalesce("added", F.lit(0)) == 0).alias("dry"),
    )
    age = (now.cast("double") - F.col("last").cast("timestamp").cast("double")) / 3600
    j = cadence.join(s, "routine", "left")
    full = F.col("n") == streak
    kinds = F.array(
        F.when(F.col("last").isNull(), "none"),
        F.when(age > factor * F.col("hours") + budget_h, "stale"),
        F.when(full & F.col("failing"), "failing").when(full & F.col("finds") & F.col("dry"), "dry"),
    )
    kinds = F.filter(kinds, lambda k: k.isNotNull())
    return j.select("routine", F.explode(kinds).alias("kind")).select(F.concat("routine", F.lit(":"), "kind").alias("key"))


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, change): what was raised and what was cleared between two sets of keys."""
    b, a = before.select("key").distinct().withColumn("b", F.lit(True)), after.select("key").distinct().withColumn("a", F.lit(True))
    j = b.join(a, "key", "full_outer").where(F.col("a").isNull() | F.col("b").isNull())
    return j.select("key", F.when(F.col("b").isNull(), "raised").otherwise("cleared").alias("change"))


def queue(candidates: DataFrame, done: DataFrame, failed: DataFrame, max_bytes: float, max_failures: int = 2) -> DataFrame:
    """The eligible rows of (id, size, whole_size) in their order: known sizes first, small first, then id.

    Not done, not failed ``max_failures`` times, and of a size (its own, else that of the whole) that is
    known and within ``max_bytes``.
    """
    worn = failed.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max_failures)
    c = candidates.join(done.select("id").distinct(), "id", "left_anti").join(worn, "id", "left_anti")
    return c.where(F.coalesce("size", "whole_size") <= max_bytes).orderBy(F.col("size").isNull(), F.coalesce("size", F.lit(0)), "id")


def upsert(rows: DataFrame, by: str, *order: Column) -> DataFrame:
    """The newest row of each key: a grouped maximum of a struct, combined before the shuffle."""
    cols = [c for c in rows.columns if c != by]
    return rows.groupBy(by).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select(by, "r.*")


def final_state(events: DataFrame) -> DataFrame:
    """(id, status, n_failures, labels): a success clears earlier failures and joins labels; skipped stays
    unless a success follows. events: (id, seq, kind, label)."""
    ok, bad, skip = (F.col("kind") == k for k in ("downloaded", "failed", "skipped"))
    done = events.where(ok).groupBy("id").agg(F.max("seq").alias("at"), F.array_sort(F.collect_set("label")).alias("labels"))
    j = events.join(done, "id", "left")
    after = F.col("at").isNull() | (F.col("seq") > F.col("at"))
    g = j.groupBy("id").agg(F.max("at").alias("at"), F.count_if(bad & after).alias("n_failures"), F.bool_or(skip).alias("skipped"), F.first("labels", True).alias("labels"))
    status = F.when(F.col("at").isNotNull(), "downloaded").when(F.col("skipped"), "skipped").when(F.col("n_failures") > 0, "failed").otherwise("new")
    return g.select("id", status.alias("status"), "n_failures", F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels"))


def run_status(added: Column, enriched: Column, errors: Column, minutes: Column, target: int, cutoff_min: float = 110) -> tuple[Column, Column]:
    """(status, stop_reason) of a finished run."""
    done = added + enriched
    status = F.when((errors > 0) & (done == 0), "failed").when(errors > 0, "partial").otherwise("ok")
    stop = F.when(added >= target, "found").when(minutes >= cutoff_min, "time-limit").otherwise("frontier-exhausted")
    return status, stop
