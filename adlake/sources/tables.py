"""Reading, publishing and inspecting tables.

Paths may carry any scheme the cluster is configured for (``s3a://``, ``hdfs://``,
``file:``); nothing here depends on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.sources import versions


class LazyTables(Mapping[str, DataFrame]):
    """Named frames, each defined when it is first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._makers = dict(makers)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._makers[name]()
        return self._frames[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Session settings for an S3-compatible store."""
    base = "spark.hadoop.fs.s3a."
    return {
        base + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        base + "endpoint": endpoint,
        base + "access.key": access_key,
        base + "secret.key": secret_key,
        base + "path.style.access": str(path_style).lower(),
    }


def layer_path(root: str, layer: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{entity}"


def read_layer(spark: SparkSession, root: str, layer: str, entity: str) -> DataFrame:
    """An entity as it is now: the current version, or the files of a plain folder."""
    return load_table(spark, layer_path(root, layer, entity), "parquet")


def write_layer(
    df: DataFrame, root: str, layer: str, entity: str, partition_by: str | None = None
) -> None:
    """Replace one entity of a layer, by default as a flat folder."""
    write_parquet(df, layer_path(root, layer, entity), partition_by)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a Parquet table in one step (see ``versions``).

    With ``partition_by`` (such as an event date) the reports on a date range read
    only their folders.
    """
    versions.replace(df, path, partition_by=partition_by)


def publish(
    df: DataFrame,
    target: str,
    fmt: str = "table",
    options: Mapping[str, str] | None = None,
) -> int:
    """Replace a result table and return the number of rows written.

    ``fmt`` is ``table`` (catalog), ``jdbc`` (``options`` hold url, user, ...), ``view`` or
    a file format with ``target`` as path. Files are replaced in one step: whoever reads
    them meanwhile has the whole old table, and keeps it if the write fails. ``view`` keeps
    such files at ``options["path"]`` and points the view of this name at the new ones. The
    rows are counted while they are written, not in a second scan.
    """
    if fmt == "view":
        path = (options or {})["path"]
        done = versions.replace(df, path)
        files = f"{path.rstrip('/')}/{done.folder}".replace("`", "``")
        df.sparkSession.sql(f"create or replace view {target} as select * from parquet.`{files}`")
        return done.rows
    if fmt not in ("table", "jdbc"):
        return versions.replace(df, target, fmt, options=options).rows
    audit = Observation()
    counted = df.observe(audit, F.count(F.lit(1)).alias("rows"))
    if fmt == "table":
        counted.write.mode("overwrite").saveAsTable(target)
    else:
        counted.write.format("jdbc").options(dbtable=target, **(options or {})).mode(
            "overwrite"
        ).save()
    return audit.get["rows"]


def load_table(
    spark: SparkSession,
    name: str,
    fmt: str = "table",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A catalog table, a SQL text (``fmt='sql'``), a JDBC table or a file folder.

    A folder that was replaced in versions gives the current one.
    """
    if fmt == "table":
        return spark.table(name)
    if fmt == "sql":
        return spark.sql(name)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=name, **(options or {})).load()
    if versions.is_versioned(spark, name):
        return versions.read(spark, name)
    return spark.read.format(fmt).options(**(options or {})).load(name)


def load_optional(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, or an empty frame of the given schema if it is missing."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def register_model(df: DataFrame, name: str, materialized: str = "view") -> DataFrame:
    """Register a result under a name, as a view or as a stored table."""
    spark = df.sparkSession
    if materialized == "view":
        df.createOrReplaceTempView(name)
    elif materialized == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization: {materialized}")
    return spark.table(name)


def cache_result(df: DataFrame) -> DataFrame:
    """Keep a shared result for several reports; call ``unpersist`` to refresh it."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows in no particular order."""
    return df.limit(n)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition; quotes inside a value are doubled."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name, column_name, data_type, position) of every table and view.

    Only catalog metadata passes through the driver.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        name = table.name
        full = ".".join([*(table.namespace or []), name]) if not table.isTemporary else name
        for position, column in enumerate(spark.catalog.listColumns(full), start=1):
            rows.append((name, column.name, column.dataType, position))
    schema = "table_name string, column_name string, data_type string, position int"
    return spark.createDataFrame(rows, schema).orderBy("table_name", "position")


def column_listing(catalog: DataFrame) -> DataFrame:
    """One row per table with its ``name (type)`` list in declared order."""
    entry = F.struct(
        "position", F.concat("column_name", F.lit(" ("), "data_type", F.lit(")")).alias("text")
    )
    return catalog.groupBy("table_name").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]).alias("columns")
    )
