"""Event streams: the batch aggregations as Structured Streaming plans with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) by tumbling window; a streaming input drops what is later than late."""
    at = events.withColumn("at", F.col("ts").cast("timestamp"))
    if at.isStreaming:
        at = at.withWatermark("at", late)
    w = at.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n", "total")
