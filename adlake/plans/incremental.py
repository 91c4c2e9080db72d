"""The campaign summary kept up to date from counts per campaign and day.

The counts of a day can be added up with those of other days, so a run reads only the days
that new micro-batches of the silver logs touched, however late their rows are, and
replaces the counts of these days. The summary then adds up counts instead of events.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.plans.marts import summarized, with_facts
from adlake.plans.staging import stage_all
from adlake.sources import versions
from adlake.sources.schemas import silver_schema
from adlake.streaming.ingest import BATCH, DAY, read_folder

LOGS = ("impressions", "clicks", "conversions")
_COUNTS = T.StructType(
    [
        T.StructField("campaign_id", T.IntegerType()),
        T.StructField("events", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 6)),
        T.StructField(DAY, T.DateType()),
    ]
)
_PROGRESS = "log string, batch long"


def _of_days(days: list[date | None]) -> Column:
    known = [d for d in days if d is not None]
    found = F.col(DAY).isin(known) if known else F.lit(False)
    return found | F.col(DAY).isNull() if len(known) < len(days) else found


def day_counts(log: str, rows: DataFrame) -> DataFrame:
    """(campaign_id, events, revenue, event_date) of silver rows; revenue null but for conversions."""
    staged = stage_all({log: rows.drop(DAY, BATCH)})[log].withColumn(DAY, F.to_date("timestamp"))
    revenue = F.sum("revenue") if log == "conversions" else F.lit(None)
    return (
        staged.groupBy("campaign_id", DAY)
        .agg(F.count(F.lit(1)).alias("events"), revenue.cast("decimal(38,6)").alias("revenue"))
        .select(*_COUNTS.names)
    )


def _progress(spark: SparkSession, root: str) -> dict[str, int]:
    path = f"{root}/progress"
    if not versions.is_versioned(spark, path):
        return {}
    # One row per log.
    return {r["log"]: r["batch"] for r in versions.read(spark, path).collect()}


def update_counts(
    spark: SparkSession, silver: Mapping[str, str], root: str
) -> dict[str, list[date | None]]:
    """Bring the counts below ``root`` up to date; returns the days read per log.

    ``silver`` maps each log to the folder that ``stream_silver`` keeps. A run that stops in
    between is made good by the next one: the days it replaced come out the same again.
    """
    root = root.rstrip("/")
    done = _progress(spark, root)
    touched: dict[str, list[date | None]] = {}
    newest = dict(done)
    for log, path in silver.items():
        stored = read_folder(spark, path, silver_schema(log))
        if stored is None:
            continue
        # Folder keys alone: no column of the logs is read.
        folders = stored.filter(F.col(BATCH) > done.get(log, -1)).groupBy(DAY).agg(F.max(BATCH).alias(BATCH)).collect()
        if not folders:
            continue
        touched[log] = [r[DAY] for r in folders]
        newest[log] = max(r[BATCH] for r in folders)
        # Batches after that are the next run's, so that no day is half counted.
        rows = stored.filter(_of_days(touched[log]) & (F.col(BATCH) <= newest[log]))
        (
            day_counts(log, rows)
            .repartition(DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(f"{root}/{log}")
        )
    if touched:
        rows = spark.createDataFrame(sorted(newest.items()), _PROGRESS)
        versions.replace(rows.coalesce(1), f"{root}/progress")
    return touched


def read_counts(spark: SparkSession, root: str, log: str) -> DataFrame:
    """The counts of a log by campaign and day; none before the first run."""
    root = root.rstrip("/")
    if log not in _progress(spark, root):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(f"{root}/{log}")


def summary_from_counts(spark: SparkSession, root: str, campaigns: DataFrame) -> DataFrame:
    """The campaign summary of all days counted so far; ``campaigns`` are staged."""
    facts = []
    for log in LOGS:
        measures = [F.sum("events").alias(f"{log}_count")]
        if log == "conversions":
            revenue = F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(38,6)"))
            measures.append(revenue.alias("total_revenue"))
        facts.append(read_counts(spark, root, log).groupBy("campaign_id").agg(*measures))
    return summarized(with_facts(campaigns, facts), campaigns)
