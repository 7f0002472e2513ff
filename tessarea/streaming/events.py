"""Event streams (an extension): the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_events(spark: SparkSession, folder: str, schema) -> DataFrame:
    """New Parquet files of a folder, as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def windowed_counts(events: DataFrame, width: str, late: str | None = None, ts: str = "ts") -> DataFrame:
    """Counts and sums by tumbling window and type; on a stream ``late`` bounds the state."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        rows = rows.withWatermark(ts, late)
    g = rows.groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("v"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "v")


def sessions(events: DataFrame, gap: str, late: str | None = None, ts: str = "ts") -> DataFrame:
    """Runs of a user's events with pauses below ``gap``."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        rows = rows.withWatermark(ts, late)
    g = rows.groupBy(F.session_window(ts, gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, late: str, keys: list[str], ts: str = "ts") -> DataFrame:
    """Repeats go: on a stream those within the watermark, in a batch all."""
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def run_once(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended as Parquet exactly once."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
