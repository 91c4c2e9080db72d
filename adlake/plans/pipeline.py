"""The whole run, from bronze records to segments, layer by layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.plans import ctr_model, model_store, segments
from adlake.plans.features import training_set, training_set_as_of, user_features
from adlake.plans.marts import campaign_summary
from adlake.plans.reports import top_features
from adlake.plans.silver import clean_and_rejected, count_rejected
from adlake.plans.staging import stage_all
from adlake.sources.schemas import ENTITIES
from adlake.sources.tables import (
    cache_result,
    layer_path,
    load_table,
    publish,
    read_layer,
    register_model,
    write_layer,
)
from adlake.streaming.ingest import with_event_date


LOGS = ("impressions", "clicks", "conversions")


def build_silver(spark: SparkSession, root: str, forbid_negative: bool = False) -> None:
    """Clean every bronze entity into the silver layer, the logs by day of the event.

    Beside each entity, ``<entity>_rejected`` holds the values that did not parse with
    their records, and ``<entity>_unparsed`` counts them. Bronze is read once.
    """
    for entity in ENTITIES:
        bronze = read_layer(spark, root, "bronze", entity)
        rows, rejected = clean_and_rejected(bronze, entity, forbid_negative)
        if entity in LOGS:
            write_layer(with_event_date(rows), root, "silver", entity, "event_date")
        else:
            write_layer(rows, root, "silver", entity)
        write_layer(rejected, root, "silver", f"{entity}_rejected")
        write_layer(count_rejected(rejected, entity), root, "silver", f"{entity}_unparsed")


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {entity: read_layer(spark, root, "silver", entity) for entity in ENTITIES}


def build_results(
    spark: SparkSession,
    root: str,
    as_of: date | str,
    compat: bool = False,
    trainer: str = "parallel",
    history_as_of: bool = False,
    **fit_options: object,
) -> dict[str, int]:
    """Marts, model and segments from the silver layer, each published before its use.

    Returns the number of rows written per result. The user features read the
    predictions, so training comes before them. The model is kept beside the results.
    ``history_as_of`` trains on histories that end before each impression.
    """
    staged = stage_all(read_silver(spark, root))
    written: dict[str, int] = {}

    def store(df: DataFrame, name: str) -> DataFrame:
        path = layer_path(root, "gold", name)
        written[name] = publish(df, path, "parquet")
        return load_table(spark, path, "parquet")

    # The mart is kept for the reports that follow in this session.
    mart = cache_result(store(campaign_summary(staged), "campaign_summary"))
    register_model(mart, "campaign_summary")
    impressions = (training_set_as_of if history_as_of else training_set)(staged)
    training = store(impressions, "ctr_training_data")
    model, predictions = ctr_model.train_and_score(training, **fit_options)
    predictions = store(predictions, "ctr_predictions")
    fitted = written["ctr_training_data"] - written["ctr_predictions"]
    model_store.save(spark, model_path(root), model, fitted, settings=fit_options)
    importance = store(ctr_model.feature_importance(spark, model), "ctr_feature_importance")
    store(top_features(importance), "ctr_top_features")
    features = store(user_features(staged, predictions, as_of, compat), "user_features")
    users = store(segments.assign_segments(features, trainer=trainer), "user_segments")
    store(segments.cluster_summary(users), "user_cluster_summary")
    return written


def model_path(root: str) -> str:
    return layer_path(root, "gold", "ctr_model")


def score_stored(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Predictions for rows of the training set's columns by the model of the last run."""
    return ctr_model.predict(model_store.load(spark, model_path(root)), rows)


def read_result(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_layer(spark, root, "gold", name)


def today() -> Column:
    """The reference day for tenure in a live run."""
    return F.current_date()
