"""Daily counts and revenue over an unbounded event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.streaming.ingest import BATCH, overwrite_batch, run_batches


def _sums() -> list:
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum(F.coalesce(F.col("revenue").cast("double"), F.lit(0.0))).alias("revenue"),
    ]


def closed_days(events: DataFrame, lateness: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    """Events and revenue per day, emitted once the watermark has passed the day's end.

    For consumers that want each day once and can do without rows later than ``lateness``
    and the days still open; ``stream_daily`` has all of them.
    """
    return (
        events.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 day"), *by)
        .agg(*_sums())
        .select(F.to_date("window.start").alias("day"), *by, "events", "revenue")
    )


def stream_daily(
    events: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ()
) -> None:
    """Store the events and revenue per day of every micro-batch, late rows included.

    ``events`` need ``timestamp`` and ``revenue``. A day gets one partial sum from every
    batch that touches it.
    """

    def each(rows: DataFrame, batch: int) -> None:
        days = rows.groupBy(F.to_date("timestamp").alias("day"), *by).agg(*_sums())
        overwrite_batch(days, path, batch)

    run_batches(events, each, checkpoint)


def read_daily(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The days that ``stream_daily`` stored, with the sums of their partial sums."""
    parts = spark.read.parquet(path).drop(BATCH)
    return parts.groupBy("day", *by).agg(
        F.sum("events").alias("events"), F.sum("revenue").alias("revenue")
    )
