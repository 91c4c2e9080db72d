"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.session import materialize as stored

# Rows that travel to a Python worker at once; long texts make larger batches a risk.
ARROW_ROWS = 512

__all__ = ["first_by_hash", "key_filter", "map_arrow", "running", "short_shuffles", "stored", "table", "with_maybe"]

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Batches, schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` with batches of few rows, as single texts may be very long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(fn, schema)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is shuffled leaves the disk as soon as its query has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def first_by_hash(df: DataFrame, by: str, hashed: Column, n: int) -> DataFrame:
    """Rows that hold the first ``n`` per value of ``by`` in the order of a 64-bit hash, and few more.

    How many rows a value has tells below which hash they lie, with a wide margin, so that
    what is ranked after this is bounded whatever the number of rows or tasks. ``by`` is a
    label of few values: their counts, one row each, are sent to the tasks.
    """
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    # Far more than chance leaves below n, as the deviation is the root of this at most.
    wanted = F.lit(2.0 * n + 64.0)
    limit = F.when(F.col("_rows") <= wanted, F.lit(2.0**63)).otherwise(wanted / F.col("_rows") * 2.0**64 - 2.0**63)
    return df.withColumn("_hash", hashed).join(F.broadcast(counts), by).filter(F.col("_hash") <= limit).drop("_hash", "_rows")


# Bits of a key filter, whatever the number of keys: 16 MB in rows of 4 kB.
FILTER_BITS, FILTER_ROW = 1 << 27, 1 << 15


def key_filter(keys: DataFrame, key: Column) -> DataFrame:
    """(_filter_row, _bits): a bitmap of fixed size that has a bit set for every key (long)."""
    at = F.pmod(key, F.lit(FILTER_BITS))
    rows = keys.select(F.floor(at / FILTER_ROW).cast("int").alias("_filter_row"), (at % FILTER_ROW).alias("bit"))
    return stored(rows.groupBy("_filter_row").agg(F.bitmap_construct_agg("bit").alias("_bits")), "filter")


def with_maybe(df: DataFrame, key: Column, found: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: false only where the key is not among those of the filter.

    Lets rows that have no partner stay where they are. With far more keys than bits it is
    true for all rows, which then meet their partners by a shuffle as they would without.
    """
    at = F.pmod(key, F.lit(FILTER_BITS))
    marked = df.withColumn("_filter_row", F.floor(at / FILTER_ROW).cast("int")).withColumn("_bit", (at % FILTER_ROW).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(_bits, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("long"), F.col("_bit") % 8) == 1
    # At most FILTER_BITS / FILTER_ROW rows.
    joined = marked.join(F.broadcast(found), "_filter_row", "left")
    return joined.withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_filter_row", "_bit", "_bits")


def running(df: DataFrame, order: Sequence[Column], values: Mapping[str, Column]) -> DataFrame:
    """Add running totals (this row included) over the whole frame in the given order.

    The rows are dealt into key ranges and stored; only one total per range is gathered.
    ``order`` must be unique for a result that is the same in every run.
    """
    inner = [f"_v{i}" for i in range(len(values))]
    ranged = stored(
        df.withColumns(dict(zip(inner, values.values())))
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()),
        "running",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(*[F.sum(v).alias(v) for v in inner])
    # One row per range: as many as shuffle partitions.
    offsets = sums.select(
        "_range", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_before") for v in inner]
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = ranged.join(F.broadcast(offsets), "_range")
    totals = {
        out: F.sum(v).over(inside) + F.col(f"{v}_before") for out, v in zip(values, inner)
    }
    return joined.withColumns(totals).drop("_range", *inner, *[f"{v}_before" for v in inner])
