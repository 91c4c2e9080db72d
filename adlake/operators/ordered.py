"""Operators that need a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.scalars import as_column
from adlake.session import materialize


def running_total(
    df: DataFrame, order_by: Sequence[Column | str], value: Column | str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to and including this one.

    The rows are range-partitioned by ``order_by`` (which should be unique), each
    range is summed once, and the totals of the preceding ranges - one row per
    range - are added to the running sum inside the range. Storing them keeps the
    assignment of rows to ranges fixed.
    """
    order = [as_column(c) for c in order_by]
    ranged = materialize(
        df.withColumn("_value", as_column(value))
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, so this window and the broadcast stay small.
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("_value").alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_before") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_value", "_range", "_before")
    )


def running_totals_by(
    df: DataFrame, by: str, order_by: Sequence[Column | str], totals: Mapping[str, Column | str]
) -> DataFrame:
    """Add per key the sums over its rows up to and including this one, for each of ``totals``.

    A key may own any share of the rows: they are dealt into ranges of (key, order), summed
    inside each range, and what the key had in the ranges before is added. Only the first
    key of a range can have such rows, so one row per range is carried over. Null keys form
    a key of their own. Rows that are equal in ``order_by`` are summed in no fixed order.
    """
    order = [as_column(c) for c in order_by]
    values = {f"_value{i}": as_column(v) for i, v in enumerate(totals.values())}
    ranged = materialize(
        df.withColumns(values)
        .repartitionByRange(by, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    firsts = ranged.groupBy("_range").agg(F.min(F.struct(F.col(by).alias("key"))).alias("_first"))
    # One row per shuffle partition each, so the broadcasts and this window stay small.
    border = firsts.select(F.col("_first.key").alias("_key")).distinct()
    same_key = F.col(by).eqNullSafe(F.col("_key"))
    sums = (
        ranged.join(F.broadcast(border), same_key)
        .groupBy("_range", "_key")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("_range").alias("_at"),
        "_key",
        *[F.sum(v).over(before).alias(f"{v}_before") for v in values],
    )
    inside = (
        Window.partitionBy("_range", by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sofar = {
        out: F.coalesce(F.col(f"{v}_before"), F.lit(0)) + F.coalesce(F.sum(v).over(inside), F.lit(0))
        for out, v in zip(totals, values)
    }
    return (
        ranged.join(F.broadcast(carried), (F.col("_range") == F.col("_at")) & same_key, "left")
        .withColumns(sofar)
        .drop("_range", "_at", "_key", *values, *[f"{v}_before" for v in values])
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: str | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (``by``, prob, quantile).

    Works on the distinct values with their counts, ranked by a running total, so
    no task holds all values of a group. Null values and null groups are left out.
    """
    group = F.col(by) if by else F.lit("")
    counted = (
        df.filter(F.col(value).isNotNull() & group.isNotNull())
        .groupBy(group.alias("_group"), F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_total(counted, ["_group", "_v"], "_n", "_upto")
    bounds = ranked.groupBy("_group").agg(
        F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_size")
    )
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    at = F.col("prob") * (F.col("_size") - 1)
    below, above = F.floor(at), F.ceil(at)
    first = F.col("_upto") - F.col("_n") - F.col("_start")
    last = F.col("_upto") - F.col("_start") - 1
    # Each quantile needs the two values at the ranks next to it.
    hits = (
        ranked.join(bounds, "_group")
        .withColumn("prob", F.explode(wanted))
        .filter(below.between(first, last) | above.between(first, last))
        .groupBy("_group", "_size", "prob")
        .agg(
            F.max(F.when(below.between(first, last), F.col("_v"))).alias("_lo"),
            F.max(F.when(above.between(first, last), F.col("_v"))).alias("_hi"),
        )
    )
    quantile = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (at - below)
    out = hits.withColumn("quantile", quantile)
    if by:
        return out.select(F.col("_group").alias(by), "prob", "quantile")
    return out.select("prob", "quantile")


def top_n(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The n rows with the largest measure, nulls last, ties by the given columns."""
    return df.orderBy(F.desc_nulls_last(measure), *ties).limit(n)


def total_of(df: DataFrame, value: Column) -> Column:
    """A whole-table aggregate as a scalar subquery column."""
    return df.agg(value.alias("total")).scalar()


def share_of_total(df: DataFrame, value: str, out: str, scale: float = 1.0) -> DataFrame:
    """Add ``value`` as a part of its sum over the whole frame."""
    total = total_of(df, F.sum(F.col(value).cast("double")))
    return df.withColumn(out, F.col(value) * scale / F.nullif(total, F.lit(0.0)))
