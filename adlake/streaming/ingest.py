"""Incremental landing and cleaning of the entity feeds.

Each job takes what has arrived since its last run and stops; the checkpoint keeps
the position, so a rerun or a lost executor neither repeats nor skips records.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.utils import AnalysisException

from adlake.plans.silver import parse_records, repair_money, silver, trim_text_columns
from adlake.session import materialize
from adlake.sources.landing import to_bronze
from adlake.sources.schemas import silver_schema

# The folder keys of a stored entity: the day of the event, and the run that wrote a row.
DAY, BATCH = "event_date", "batch"


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to a Parquet folder and wait for the end."""
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    _finish(writer, checkpoint)


def run_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand everything available to ``each`` in micro-batches and wait for the end."""
    _finish(stream.writeStream.foreachBatch(each), checkpoint)


def land_bronze(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Messages of a topic or folder to ``json_record`` rows."""
    run_available(to_bronze(messages), path, checkpoint)


def with_event_date(df: DataFrame) -> DataFrame:
    """Add ``event_date``, the folder key for date-partitioned logs."""
    return df.withColumn(DAY, F.to_date("timestamp"))


def _dated(df: DataFrame) -> DataFrame:
    if "timestamp" in df.columns:
        return with_event_date(df)
    return df.withColumn(DAY, F.lit(None).cast("date"))


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """An entity's rows with the keys of its folders, day and batch; None if there is no folder."""
    full = T.StructType(
        [*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())]
    )
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def overwrite_batch(df: DataFrame, path: str, batch: int, *keys: str) -> None:
    """Write the rows of one micro-batch; a repeated batch replaces what it wrote before."""
    (
        df.withColumn(BATCH, F.lit(batch).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys, BATCH)
        .parquet(path)
    )


def _same(left: str, right: str, columns: list[str]) -> Column:
    parts = [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns]
    return reduce(Column.__and__, parts)


def _append_new(
    fresh: DataFrame, batch: int, path: str, schema: T.StructType, compared: Column | None = None
) -> None:
    """Write the rows that the stored entity does not hold yet.

    Rows for which ``compared`` holds (by default all) are looked up in the folders of their
    days; without any such row nothing is read.
    """
    spark = fresh.sparkSession
    columns = [*schema.names, DAY]
    doubtful = fresh if compared is None else fresh.filter(compared)
    # One value per day of the batch.
    days = [r[DAY] for r in doubtful.select(DAY).distinct().collect()]
    stored = read_folder(spark, path, schema) if days else None
    if stored is None:
        overwrite_batch(fresh.select(*columns), path, batch, DAY)
        return
    known = [d for d in days if d is not None]
    touched = F.col(DAY).isin(known) if known else F.lit(False)
    if len(known) < len(days):
        touched = touched | F.col(DAY).isNull()
    earlier = stored.filter(touched & (F.col(BATCH) != batch))
    new = doubtful.select(*columns).alias("f").join(earlier.alias("e"), _same("f", "e", columns), "left_anti")
    if compared is not None:
        new = new.union(fresh.filter(~compared).select(*columns))
    overwrite_batch(new, path, batch, DAY)


def append_silver(
    bronze: DataFrame, batch: int, path: str, entity: str, forbid_negative: bool = False
) -> None:
    """Add the rows of one micro-batch that the stored entity does not hold yet.

    They are compared with what earlier batches stored for the days they touch (records
    without a time form a day of their own), however late they come, so that the result
    equals cleaning all records at once. Only the folders of these days are read.
    """
    fresh = materialize(_dated(silver(bronze, entity, forbid_negative)), "batch")
    _append_new(fresh, batch, path, silver_schema(entity))


def stream_silver(
    bronze: DataFrame, entity: str, path: str, checkpoint: str, forbid_negative: bool = False
) -> None:
    """Clean a stream of bronze records into the folder of an entity and wait for the end."""

    def each(records: DataFrame, batch: int) -> None:
        append_silver(records, batch, path, entity, forbid_negative)

    run_batches(bronze, each, checkpoint)


def row_digest(df: DataFrame) -> Column:
    """128 bits that tell rows apart: equal for equal rows, nulls included."""
    values = [
        F.col(f"`{f.name}`") + 0.0 if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    # A hash passes over nulls; their places are hashed as well.
    places = F.concat(*[F.isnull(v).cast("int").cast("string") for v in values])
    halves = [F.xxhash64(F.lit(seed), places, *values) for seed in (0, 1)]
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])


# State on the executors' disks. A batch stores what it changed; whole copies of the state
# follow in the background, so that a batch of few rows costs little however much is known.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Parts of the state for each core.
STATE_PARTS_PER_CORE = 2
_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """The settings of the state while a query starts; running ones keep their own.

    Every batch opens, changes and commits every part of the state, and writes files from
    each. Parts lie on disk whatever their size, so there are as many as the cores can use,
    not as many as a shuffle of all rows would have. A checkpoint keeps the number of parts
    that it began with.
    """
    parts = min(int(spark.conf.get(_PARTITIONS)), STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism)
    settings = {**_STATE, _PARTITIONS: str(parts)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _far_days(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(f"day date, {BATCH} long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"day date, {BATCH} long")


def stream_silver_by_state(
    bronze: DataFrame,
    entity: str,
    path: str,
    checkpoint: str,
    horizon_hours: int = 48,
    ahead_hours: int = 1,
    clock: Column | None = None,
    forbid_negative: bool = False,
) -> None:
    """``stream_silver`` for feeds that mostly bring recent records: the stored rows are not
    read back for them.

    A state store remembers the digest of every row for ``horizon_hours`` after its arrival
    (``clock``, by default the start of the micro-batch; it must not run backwards). The
    copies of an event of the last ``horizon_hours`` all arrived since, so the state knows
    them and a batch of such rows only writes. Everything else is compared with the stored
    rows of its days as in ``stream_silver``, so that the result is the same:

    - older events, and records without a time;
    - events more than ``ahead_hours`` in the future, and all later rows of their days
      (kept beside the entity, in ``<path>_far``), as the state may forget those too early.

    Entities without a time (users, campaigns) are remembered for good, by digest alone, and
    never read back.
    """
    spark = bronze.sparkSession
    schema = silver_schema(entity)
    rows = repair_money(trim_text_columns(parse_records(bronze, entity)), entity, forbid_negative)
    timed = "timestamp" in schema.names
    rows = _dated(rows).withColumn("_digest", row_digest(rows))
    now = F.current_timestamp() if clock is None else clock
    far_path = f"{path.rstrip('/')}_far"
    if timed:
        rows = rows.withColumn("_clock", now).withWatermark("_clock", f"{horizon_hours + ahead_hours} hours")
        unique = rows.dropDuplicatesWithinWatermark(["_digest"])
    else:
        unique = rows.dropDuplicates(["_digest"])

    def each(batch_rows: DataFrame, batch: int) -> None:
        fresh = materialize(batch_rows.drop("_digest"), "batch")
        if not timed:
            _append_new(fresh, batch, path, schema, F.lit(False))
            return
        hours = lambda n: F.make_interval(hours=F.lit(n))
        time = F.col("timestamp")
        far = time > F.col("_clock") + hours(ahead_hours)
        recent = (time > F.col("_clock") - hours(horizon_hours)) & ~far
        # Days, one value each.
        far_days = [r["day"] for r in _far_days(spark, far_path).filter(F.col(BATCH) != batch).select("day").distinct().collect()]
        if far_days:
            recent = recent & ~F.col(DAY).isin(far_days)
        compared = ~F.coalesce(recent, F.lit(False))
        days = fresh.filter(far).select(F.col(DAY).alias("day")).distinct()
        if not days.isEmpty():
            # Ahead of the rows: a run that stops in between only compares more.
            overwrite_batch(days, far_path, batch)
        _append_new(fresh, batch, path, schema, compared)

    with _rocksdb(spark):
        run_batches(unique, each, checkpoint)


def read_silver(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """The rows that ``stream_silver`` stored, in the columns of the entity."""
    schema = silver_schema(entity)
    stored = read_folder(spark, path, schema)
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)
