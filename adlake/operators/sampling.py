"""Reproducible sampling by hashed row ids."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.ordered import running_total

# Rows that share one hash prefix, about: those that one task ranks.
PREFIX_ROWS = 4_096


def unit_hash(*parts: Column | str | int) -> Column:
    """A number in (0, 1], fixed by the values of ``parts``."""
    columns = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return (F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) + 1) / float(1 << 52)


def stratified_split(
    df: DataFrame, label: str, row_id: str, test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: an exact share of the rows, split over the labels in proportion.

    Per label, the rows with the smallest hashed ids form the test part. Counting
    rows per hash prefix finds the prefix in which the cut falls, so only the rows of
    that prefix are ranked. The prefix grows with the rows: about ``PREFIX_ROWS`` rows
    share one. ``row_id`` must be unique, and ``label`` have few values.
    """
    keyed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.col(row_id), F.lit(seed))))
    digits = max(1, ceil(log(max(df.count(), 1) / PREFIX_ROWS + 1, 16)))
    keyed = keyed.withColumn("_prefix", F.substring("_hash", 1, digits))
    counts = keyed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_n"))

    # One row per label from here to `quota`.
    everything = Window.partitionBy()
    sizes = counts.groupBy(label).agg(F.sum("_n").alias("_size"))
    total = F.sum("_size").over(everything)
    test_rows = F.ceil(total * F.lit(test_fraction))
    exact = test_rows * F.col("_size") / total
    sizes = sizes.select(
        label,
        test_rows.alias("_test_rows"),
        F.floor(exact).alias("_floor"),
        (exact - F.floor(exact)).alias("_rest"),
    )
    spare = F.col("_test_rows") - F.sum("_floor").over(everything)
    by_rest = Window.orderBy(F.desc("_rest"), label)
    quota = sizes.select(
        label,
        (F.col("_floor") + F.when(F.row_number().over(by_rest) <= spare, 1).otherwise(0)).alias(
            "_quota"
        ),
    )

    upto = running_total(counts.select(label, "_prefix", "_n"), [label, "_prefix"], "_n", "_all")
    first = upto.groupBy(label).agg(F.min(F.col("_all") - F.col("_n")).alias("_start"))
    edge = (
        upto.join(first, label)
        .withColumn("_upto", F.col("_all") - F.col("_start"))
        .join(F.broadcast(quota), label)
        .filter(F.col("_quota").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
        .select(label, "_prefix", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_keep"))
    )
    in_edge = Window.partitionBy(label, "_prefix").orderBy("_hash", row_id)
    cut = (
        keyed.select(label, "_prefix", "_hash", row_id)
        .join(F.broadcast(edge), [label, "_prefix"])
        .withColumn("_rank", F.row_number().over(in_edge))
        .filter(F.col("_rank") == F.col("_keep"))
        .select(label, F.struct(F.col("_hash").alias("h"), F.col(row_id).alias("i")).alias("_cut"))
    )
    position = F.struct(F.col("_hash").alias("h"), F.col(row_id).alias("i"))
    return (
        keyed.join(F.broadcast(cut), label, "left")
        .withColumn("is_test", F.coalesce(position <= F.col("_cut"), F.lit(False)))
        .drop("_hash", "_prefix", "_cut")
    )
