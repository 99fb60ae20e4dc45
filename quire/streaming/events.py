"""Structured Streaming extension: incremental text and event pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def stream_parquet(spark: SparkSession, folder: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events by type in tumbling windows; late ones up to the watermark."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(F.window("ts", size).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "total")
    )


def sessions(events: DataFrame, gap: str = "90 seconds", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user that end after a gap."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(F.session_window("ts", gap).alias("w"), "user_id")
        .agg(F.count("*").alias("n"))
        .select("user_id", F.col("w.start").alias("start"), "n")
    )


def comparisons(pages: DataFrame) -> DataFrame:
    """Pages compared as they arrive."""
    return pages.select(
        "page_key", X.compare_texts(F.col("text_layer"), F.col("native_text")).alias("comparison")
    )


def run_once(df: DataFrame, folder: str, checkpoint: str, mode: str = "append"):
    """Processes what is there and stops; the checkpoint makes it exactly once."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(folder)
    query.awaitTermination()
    return query
