"""Uniqueness of a log's key, checked day by day against digests of the days before.

A digest is 64 bits of the key. The digests of a day are kept beside the log; a new day is
compared with those alone, and only keys whose digests meet again are looked at in the
log itself, in the days that hold them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from adlake.operators.quality import not_unique

DAY = "event_date"
_DIGESTS = f"digest long, n long, {DAY} date"


def _of_days(days: list[date | None]) -> Column:
    known = [d for d in days if d is not None]
    found = F.col(DAY).isin(known) if known else F.lit(False)
    return F.coalesce(found, F.lit(False)) | F.col(DAY).isNull() if None in days else found


def _read(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_DIGESTS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _DIGESTS)


def _keep(rows: DataFrame, path: str) -> None:
    """Replace the days that ``rows`` hold."""
    (
        rows.select("digest", "n", DAY)
        .repartition(DAY, F.pmod("digest", F.lit(16)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def check_days(log: DataFrame, column: str, root: str, days: list[date | None]) -> None:
    """Take days of ``log`` (column, event_date, ...) into the digests below ``root``.

    Only the folders of these days are read, and the digests of all others. A day may be
    taken again, when rows came late; null keys are no keys.
    """
    spark = log.sparkSession
    kept, doubtful = f"{root.rstrip('/')}/digests", f"{root.rstrip('/')}/suspects"
    fresh = (
        log.filter(_of_days(days) & F.col(column).isNotNull())
        .groupBy(F.xxhash64(column).alias("digest"), DAY)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    _keep(fresh, kept)
    every = _read(spark, kept)
    new, others = every.filter(_of_days(days)), every.filter(~F.coalesce(_of_days(days), F.lit(False)))
    # Among the new days, within one of them, or with any day before.
    among = new.groupBy("digest").agg(F.sum("n").alias("rows")).filter("rows > 1").select("digest")
    before = new.select("digest").distinct().join(others.select("digest"), "digest", "left_semi")
    found = new.join(among.union(before).distinct(), "digest", "left_semi")
    _keep(found, doubtful)


def repeated_keys(log: DataFrame, column: str, root: str) -> DataFrame:
    """``not_unique`` of the days taken so far, exactly: keys with their row counts.

    Digests that met may be of different keys, so the rows that have them are counted by
    key; days without such a digest are not read.
    """
    spark = log.sparkSession
    suspects = _read(spark, f"{root.rstrip('/')}/suspects").select("digest").distinct()
    holders = _read(spark, f"{root.rstrip('/')}/digests").join(suspects, "digest", "left_semi")
    # One value per day.
    days = [r[DAY] for r in holders.select(DAY).distinct().collect()]
    rows = log.filter(_of_days(days)) if days else log.limit(0)
    same = F.xxhash64(F.col(column)) == F.col("digest")
    return not_unique(rows.join(suspects, same, "left_semi").select(column), column)
