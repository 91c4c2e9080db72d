"""Quantiles of any range of days from sketches that are kept per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Size of a sketch: values that it keeps per level.
SIZE = 800
# A quantile's true rank is within this share of the rows, at 99 % confidence for one
# quantile: about 2.446 / SIZE ** 0.943, by the sketch's published error.
RANK_ERROR = 2.446 / SIZE**0.943


def value_sketches(df: DataFrame, value: str, by: Sequence[str], size: int = SIZE) -> DataFrame:
    """(by ..., n, sketch): one KLL sketch of the values of each group, built map-side.

    Null values and NaN are left out; groups without a value have no row.
    """
    number = F.col(value).cast("double")
    kept = df.filter(number.isNotNull() & ~F.isnan(number)).withColumn("_value", number)
    return kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_value", size).alias("sketch")
    )


def sketched_quantiles(
    sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = (), size: int = SIZE
) -> DataFrame:
    """(by ..., n, prob, quantile) from sketches of finer groups, such as days, merged.

    Each quantile is one of the values; its rank is within ``RANK_ERROR`` of ``prob`` (at
    the default size). Groups of no more values than a sketch keeps are exact.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("_sketch")
    )
    found = [
        F.struct(
            F.lit(float(p)).alias("prob"),
            F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias("quantile"),
        )
        for p in probs
    ]
    return merged.filter(F.col("n") > 0).select(*by, "n", F.inline(F.array(*found)))
