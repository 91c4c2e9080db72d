"""Stored results with an age, for reports that many readers ask for."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from adlake.sources import versions

MAX_AGE = timedelta(minutes=5)


@contextmanager
def _whole_plans(spark: SparkSession) -> Iterator[None]:
    """Plans as text with all their columns."""
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(1 << 20))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def result_key(df: DataFrame) -> str | None:
    """A digest of what ``df`` computes and of the files it reads; None if these do not settle it.

    Equal plans over unchanged files have equal keys, however they were put together. Rows
    that came from the driver have no files to tell whether they changed.
    """
    spark = df.sparkSession
    with _whole_plans(spark):
        plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    files = df.inputFiles()
    if not files or "LogicalRDD" in plan or "ExistingRDD" in plan:
        return None
    digest = hashlib.sha256(f"{df.semanticHash()}\n{plan}\n".encode())
    digest.update(versions.fingerprint(spark, {"": df}).encode())
    return digest.hexdigest()


def cached(df: DataFrame, root: str, max_age: timedelta = MAX_AGE) -> DataFrame:
    """The rows of ``df`` as they were stored at most ``max_age`` ago, stored now if need be.

    Any session that asks for the same result of the same files below the same ``root``
    shares it; a hit reads the stored rows and nothing else. A changed source is another
    result, so nothing stale is served from it; the age bounds what files cannot show, such
    as the current date in a plan. Readers keep what they read when it is renewed.
    """
    spark = df.sparkSession
    key = result_key(df)
    if key is None:
        return df
    path = f"{root.rstrip('/')}/{key}"
    found = versions.current(spark, path)
    now = datetime.now(timezone.utc).timestamp()
    if found is None or now - found.committed > max_age.total_seconds():
        versions.replace(df, path)
    return versions.read(spark, path)


def sweep(spark: SparkSession, root: str, unused: timedelta = timedelta(days=1)) -> int:
    """Remove results that were last stored longer than ``unused`` ago; returns how many."""
    files = versions._Files(spark, root)
    before = datetime.now(timezone.utc).timestamp() - unused.total_seconds()
    removed = 0
    for key in files.names("."):
        found = versions.current(spark, f"{root.rstrip('/')}/{key}")
        if found is not None and found.committed < before:
            files.remove(key)
            removed += 1
    return removed
