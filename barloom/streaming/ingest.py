"""Streams beyond the batch engine: landing files merged into the store, and daily bars from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import quality
from barloom.operators.store import Store
from barloom.schemas import BARS


def merge_stream(spark: SparkSession, landing: str, path: str, checkpoint: str) -> StreamingQuery:
    """Cleans each batch of landed bars and merges it; a replayed batch changes nothing."""
    schema = T.StructType([*BARS.fields, T.StructField("board", T.StringType()), T.StructField("seq", T.LongType())])

    def merge_batch(batch: DataFrame, _: int) -> None:
        clean = quality.sanitize(batch)
        if not clean.isEmpty():
            Store(spark, path).merge(clean)

    rows = spark.readStream.schema(schema).parquet(landing)
    return rows.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_bars(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Per user and day: first and last by event id, high, low, count; works on a stream with a watermark, and on a table."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    day = F.window("ts", "1 day")
    out = rows.groupBy(F.col("user_id"), day).agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"), F.count("*").alias("volume"))
    return out.select(F.col("user_id").cast("string").alias("ticker"), F.to_date("window.start").alias("date"), "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"))
