from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adlake.plans import ctr_model, pipeline, reports, segments
from adlake.plans.features import training_set_as_of, user_features
from adlake.plans.staging import stage_all
from adlake.session import work_dir, work_path
from adlake.sources import schemas, tables, testdata
from helpers import staged_frames

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for entity in schemas.ENTITIES:
        tables.write_layer(testdata.bronze_records(spark, SF, entity), root, "bronze", entity)
    pipeline.build_silver(spark, root)
    pipeline.build_results(spark, root, "2024-02-01", rounds=2, depth=2)
    return root


def test_all_results_are_stored(spark, root):
    staged = stage_all(pipeline.read_silver(spark, root))
    mart = pipeline.read_result(spark, root, "campaign_summary")
    assert mart.count() == staged["campaigns"].count()
    training = pipeline.read_result(spark, root, "ctr_training_data")
    predictions = pipeline.read_result(spark, root, "ctr_predictions")
    assert predictions.columns == schemas.PREDICTIONS_SCHEMA.names
    assert [f.dataType for f in predictions.schema] == [f.dataType for f in schemas.PREDICTIONS_SCHEMA]
    assert 0 < predictions.count() == -(-training.count() // 5)
    assert predictions.filter("predicted_prob not between 0 and 1").count() == 0
    importance = pipeline.read_result(spark, root, "ctr_feature_importance")
    assert {r["feature"] for r in importance.collect()} == set(ctr_model.FEATURES)
    users = pipeline.read_result(spark, root, "user_segments")
    assert users.columns == schemas.SEGMENTS_SCHEMA.names
    assert [f.dataType for f in users.schema] == [f.dataType for f in schemas.SEGMENTS_SCHEMA]
    assert users.count() == staged["users"].count()
    summary = pipeline.read_result(spark, root, "user_cluster_summary")
    assert summary.count() == users.select("user_cluster").distinct().count() <= 4


def test_reports_read_the_stored_results(spark, root):
    predictions = pipeline.read_result(spark, root, "ctr_predictions")
    volume = reports.calibration(predictions).agg(F.sum("volume")).first()[0]
    assert volume in (predictions.count(), None)  # null if all scores are equal
    users = pipeline.read_result(spark, root, "user_segments")
    summary = pipeline.read_result(spark, root, "user_cluster_summary")
    assert segments.segment_kpis(users, summary).first()["total_users"] == users.count()


def test_written_rows_are_counted(spark, root):
    written = pipeline.build_results(
        spark, root, "2024-02-01", trainer="minibatch", rounds=1, depth=1
    )
    for name, rows in written.items():
        assert pipeline.read_result(spark, root, name).count() == rows
    assert spark.table("campaign_summary").count() == written["campaign_summary"]


def test_the_model_is_kept(spark, root):
    """Scores of the stored model are those of the run that stored it."""
    stored = pipeline.read_result(spark, root, "ctr_predictions")
    rows = pipeline.read_result(spark, root, "ctr_training_data").join(stored.select("impression_id"), "impression_id", "left_semi")
    again = pipeline.score_stored(spark, root, rows)
    key = ["impression_id", "predicted_prob", "predicted_clicked"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, stored.select(key).collect()))


def test_training_on_histories_that_end_before(spark, root):
    pipeline.build_results(spark, root, "2024-02-01", history_as_of=True, rounds=1, depth=1)
    staged = stage_all(pipeline.read_silver(spark, root))
    got = pipeline.read_result(spark, root, "ctr_training_data")
    want = training_set_as_of(staged)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_logs_are_cut_by_their_folders(spark, root):
    lake = pipeline.read_silver(spark, root)
    logs = [lake[log] for log in pipeline.LOGS]
    days = reports.daily_report(lake["campaigns"], *logs, "2024-01-03", "2024-01-06")
    assert [str(r["day"]) for r in days.collect()] == [f"2024-01-0{d}" for d in range(3, 7)]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") >= 3
    every = reports.daily_report(lake["campaigns"], *logs)
    kept = every.filter("day between date'2024-01-03' and date'2024-01-06'")
    assert sorted(map(str, days.collect())) == sorted(map(str, kept.collect()))


def test_unparsed_values_are_stored(spark, root):
    found = tables.read_layer(spark, root, "silver", "conversions_unparsed")
    assert {r["column_name"] for r in found.filter("unparsed > 0").collect()} >= {"revenue"}


def test_tenure_of_today(spark):
    staged = staged_frames(spark)
    none = spark.createDataFrame(
        [], "ad_format string, device string, target_region string, predicted_prob double"
    )
    got = user_features(staged, none, pipeline.today())
    want = staged["users"].select("user_id", F.datediff(F.current_date(), "signup_date").alias("d"))
    assert got.join(want, "user_id").filter("not (days_since_signup <=> d)").count() == 0
    assert got.filter("avg_ctr_score != 0").count() == 0


def test_work_dir_is_the_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_dir(spark) == named
    assert work_path(spark, "x").startswith(work_dir(spark).rstrip("/") + "/x-")
    assert work_path(spark, "x") != work_path(spark, "x")
    assert spark.sparkContext.getCheckpointDir()
