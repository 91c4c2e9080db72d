"""Starter models: a union with a null row, and a filter on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_null_id(ids: DataFrame) -> DataFrame:
    """UNION ALL of the ids and one row whose id is null."""
    kind = ids.schema["id"].dataType
    missing = ids.sparkSession.range(1).select(F.lit(None).cast(kind).alias("id"))
    return ids.select("id").unionByName(missing)


def equal_to(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == value)
