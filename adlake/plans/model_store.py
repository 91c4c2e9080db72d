"""Click models that outlive the session that fitted them.

A store is a versioned folder (see ``adlake.sources.versions``): each version holds the
fitted pipeline, the statistics that scale its inputs, and in the log what it was fitted
to and how.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.plans.ctr_model import ClickModel
from adlake.sources import versions

# Models stay long, so that older scores can be explained.
KEEP = timedelta(days=365)
_FMT = "click-model"
_TABLE = "version int, committed timestamp, fit_rows long, inputs string, settings string, scaled array<struct<feature: string, mean: double, std: double>>"


def save(
    spark: SparkSession,
    path: str,
    model: ClickModel,
    fit_rows: int,
    inputs: str = "",
    settings: Mapping[str, object] | None = None,
    keep: timedelta = KEEP,
) -> int:
    """Store a model as the next version and return its number."""
    folder = versions.new_folder()
    base = f"{path.rstrip('/')}/{folder}"
    model.pipeline.write().save(f"{base}/pipeline")
    model.statistics.coalesce(1).write.parquet(f"{base}/statistics")
    scaled = [[r["feature"], r["mean"], r["std"]] for r in model.statistics.collect()]
    about = {"inputs": inputs, "settings": _text(settings), "scaled": json.dumps(scaled)}
    return versions.commit(spark, path, folder, fit_rows, _FMT, options=about, keep=keep).number


def _text(settings: Mapping[str, object] | None) -> str:
    return json.dumps(dict(settings or {}), sort_keys=True)


def _load(spark: SparkSession, path: str, version: versions.Version) -> ClickModel:
    base = f"{path.rstrip('/')}/{version.folder}"
    statistics = spark.read.schema("feature string, mean double, std double").parquet(f"{base}/statistics")
    return ClickModel(PipelineModel.load(f"{base}/pipeline"), statistics)


def load(spark: SparkSession, path: str, number: int | None = None) -> ClickModel:
    """The newest model of a store, or the given version."""
    found = [v for v in versions.versions(spark, path) if number in (None, v.number)]
    if not found:
        raise LookupError(f"no such model in {path}")
    return _load(spark, path, found[-1])


def model_table(spark: SparkSession, path: str) -> DataFrame:
    """The models of a store, oldest first: one row each."""
    rows = [
        (
            v.number,
            v.committed,
            v.rows,
            v.options["inputs"],
            v.options["settings"],
            [tuple(s) for s in json.loads(v.options["scaled"])],
        )
        for v in versions.versions(spark, path)
    ]
    plain = spark.createDataFrame(rows, _TABLE.replace("committed timestamp", "committed double"))
    return plain.withColumn("committed", F.timestamp_seconds("committed")).orderBy("version")


def get_or_fit(
    spark: SparkSession,
    path: str,
    sources: Mapping[str, DataFrame],
    fit: Callable[[], tuple[ClickModel, int]],
    settings: Mapping[str, object] | None = None,
) -> ClickModel:
    """The newest model that was fitted to these files with these settings; fitted if there is none.

    ``fit`` gives a model and the number of rows it saw. Files are told apart by name, size
    and time, so a changed table never gives an old model. What is returned is read from the
    store in either case.
    """
    inputs = versions.fingerprint(spark, sources)
    wanted = _text(settings)
    for version in reversed(versions.versions(spark, path)):
        if version.options["inputs"] == inputs and version.options["settings"] == wanted:
            return _load(spark, path, version)
    model, rows = fit()
    return load(spark, path, save(spark, path, model, rows, inputs, settings))
