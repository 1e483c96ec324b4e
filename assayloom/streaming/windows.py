"""Structured Streaming over events: windows with a watermark, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """window_start, event_type, n, for batch and stream alike; in a stream events later than the watermark are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, session_start, session_end, n: runs of events less than `gap` apart."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a folder of Parquet files as a stream."""
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there into an in-memory table and stops."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
