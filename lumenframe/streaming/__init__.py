"""Structured Streaming forms of the event aggregates, and batch forms that they are held against."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed(events: DataFrame, length: str = "6 hours", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of tumbling or sliding windows behind a watermark."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    e = events.withWatermark("ts", late) if events.isStreaming else events
    g = e.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n) of sessions parted by a gap."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    g = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def drained(spark: SparkSession, stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream over what is there now, to its end, and return the result as a table.

    Each micro-batch replaces the files of the result, written by the tasks; ``folder`` is by default
    a new one below ``spark.checkpoint.dir``, which a cluster has to name.
    """
    shared = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir, or name a folder that driver and executors share")
    path = f"{shared.rstrip('/')}/stream-{uuid.uuid4().hex}"

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows")

    q = stream.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", f"{path}/progress")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
