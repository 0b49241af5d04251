"""Incremental intake with Structured Streaming: each run takes what is new and stops; replays change nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def drain(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str,
        transform: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Run transform over the files that came since the last run; a batch is written under its number, so that a replay overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    query = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation",
        checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def first_copies(stream: DataFrame, content: str, at: str, late: str = "1 hour") -> DataFrame:
    """Rows whose content did not come before within the watermark."""
    return stream.withColumn("sha256", F.sha2(content, 256)).withWatermark(at,
        late).dropDuplicatesWithinWatermark(["sha256"])


def windowed_counts(stream: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts by tumbling window; rows later than the watermark are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))


def session_counts(stream: DataFrame, at: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), by).agg(F.count(F.lit(1)).alias("n"))
