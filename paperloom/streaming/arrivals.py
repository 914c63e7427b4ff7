"""Streams of arriving records: statuses by window, latest version of each, resumable batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 16) -> DataFrame:
    """Parquet files as they arrive in a folder; each is read once, which lock files did by hand."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _timed(stream: DataFrame, time: str) -> DataFrame:
    """The stream with its time as a timestamp that a watermark can follow."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def status_by_window(stream: DataFrame, time: str, status: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Number of records of each status per window; records later than ``late`` are not counted (C4)."""
    return _timed(stream, time).withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.col(status).alias("status")).agg(
        F.count("*").alias("records")
    ).select(F.col("w.start").alias("start"), "status", "records")


def first_seen(stream: DataFrame, key: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Each record once, however often it is delivered within the watermark."""
    return _timed(stream, time).withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes what is there to Parquet and ends; run again, it goes on where it ended."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    return query
