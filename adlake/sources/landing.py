"""CSV rows to JSON messages to the bronze layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.sources.schemas import BRONZE_SCHEMA


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header; every column stays text, quoted commas and quotes are kept.

    An empty field is an empty text, not a null. ``multi_line`` allows line breaks
    inside quotes, at the price that a file can no longer be split over tasks.
    """
    rows = spark.read.csv(path, header=True, escape='"', multiLine=multi_line, inferSchema=False)
    return rows.na.fill("")


def as_messages(rows: DataFrame) -> DataFrame:
    """One JSON text ``value`` per row, all fields written as strings.

    A null field is left out of the message.
    """
    return rows.select(
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns])).alias(
            "value"
        )
    )


def write_messages(
    messages: DataFrame, target: str, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> None:
    """Append messages to a topic (``fmt='kafka'``) or to a folder (``fmt='text'``)."""
    writer = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        writer.option("topic", target).save()
    else:
        writer.mode("append").save(target)


def read_messages(
    spark: SparkSession, source: str, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Everything from the earliest to the latest message of a topic or a folder."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return (
            reader.option("subscribe", source)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
        )
    return reader.load(source)


def stream_messages(
    spark: SparkSession, source: str, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """The same source as an unbounded stream."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.option("subscribe", source).option("startingOffsets", "earliest").load()
    if fmt == "parquet":
        reader = reader.schema(BRONZE_SCHEMA)
    return reader.load(source)


def to_bronze(messages: DataFrame) -> DataFrame:
    """Message bytes or text as the single column ``json_record``."""
    return messages.select(F.col("value").cast("string").alias("json_record"))
