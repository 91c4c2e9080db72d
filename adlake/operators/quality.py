"""Column checks that return the violating rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, with their row counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is null."""
    return df.filter(F.col(column).isNull())


def check_report(tables: dict[str, DataFrame], checks: list[tuple[str, str, str]]) -> DataFrame:
    """One row per (table, column, check) with the number of failures.

    ``checks`` lists (table, column, kind) with kind ``unique`` or ``not_null``. Counting
    the rows per value, null included, answers both kinds, so each column is read once.
    """
    columns: dict[tuple[str, str], list[str]] = {}
    for table, column, kind in checks:
        columns.setdefault((table, column), []).append(kind)
    parts = []
    for (table, column), kinds in columns.items():
        value = F.col(column)
        found = {
            "unique": F.count_if(value.isNotNull() & (F.col("_n") > 1)),
            "not_null": F.coalesce(F.sum(F.when(value.isNull(), F.col("_n"))), F.lit(0)),
        }
        counted = tables[table].groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        rows = [F.struct(F.lit(k).alias("check_name"), F.col(k).alias("failures")) for k in kinds]
        parts.append(
            counted.agg(*[found[k].cast("long").alias(k) for k in kinds]).select(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.inline(F.array(*rows)),
            )
        )
    return reduce(DataFrame.unionByName, parts)
