"""The campaign summary from counts per day, and results stored with an age."""

from __future__ import annotations

import os
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from adlake.plans import incremental
from adlake.plans.marts import campaign_summary
from adlake.plans.silver import silver
from adlake.plans.staging import stage_all
from adlake.sources import results, testdata, versions
from adlake.streaming import ingest
from helpers import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark, tmp_path):
    """Bronze records of the logs, half of them cleaned; some halves bring copies and late rows."""
    paths = {log: str(tmp_path / log) for log in incremental.LOGS}
    records = {log: testdata.bronze_records(spark, SF, log) for log in paths}
    half = F.pmod(F.xxhash64("json_record"), F.lit(2)) == 0
    early = F.get_json_object("json_record", "$.timestamp") < "2024-01-25"
    parts = (half & early, ~half & early, F.lit(True))
    return paths, records, parts, str(tmp_path / "counts")


def test_equal_to_the_full_run(spark, lake):
    """Late rows, repeated records and records without a time, batch after batch."""
    paths, records, parts, counts = lake
    raw = testdata.silver_tables(spark, SF)
    campaigns = stage_all(raw)["campaigns"]
    assert incremental.update_counts(spark, paths, counts) == {}
    assert incremental.summary_from_counts(spark, counts, campaigns).filter("clicks_count > 0").count() == 0
    for batch, part in enumerate(parts):
        for log, path in paths.items():
            ingest.append_silver(records[log].filter(part), batch, path, log)
        assert set(incremental.update_counts(spark, paths, counts)) == set(paths)
        logs = {log: ingest.read_silver(spark, log, path) for log, path in paths.items()}
        want = campaign_summary(stage_all({**dict(raw), **logs}))
        got = incremental.summary_from_counts(spark, counts, campaigns)
        assert rows(got) == rows(want)
    every = {log: silver(records[log], log) for log in paths}
    assert rows(got) == rows(campaign_summary(stage_all({**dict(raw), **every})))
    assert incremental.update_counts(spark, paths, counts) == {}


def test_only_touched_days_are_read(spark, tmp_path, monkeypatch):
    path, counts = str(tmp_path / "clicks"), str(tmp_path / "counts")
    clicks = ingest.with_event_date(testdata.silver_tables(spark, SF)["clicks"])
    ingest.overwrite_batch(clicks.filter("event_date < '2024-01-20'"), path, 0, ingest.DAY)
    incremental.update_counts(spark, {"clicks": path}, counts)
    late = (F.col("event_date") == "2024-01-20") | (F.col("event_date") == "2024-01-03") & (F.col("click_id") % 2 == 0)
    ingest.overwrite_batch(clicks.filter(late), path, 1, ingest.DAY)
    read, plain = [], incremental.day_counts

    def watched(log, frame):
        read.append(frame._jdf.queryExecution().executedPlan().toString())
        return plain(log, frame)

    monkeypatch.setattr(incremental, "day_counts", watched)
    days = incremental.update_counts(spark, {"clicks": path}, counts)["clicks"]
    assert sorted(days) == [date(2024, 1, 3), date(2024, 1, 20)]
    # The folders are chosen before any file is opened.
    assert len(read) == 1
    keys = re.search(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", read[0]).group(1)
    assert "event_date" in keys and "2024-01-03" in keys and "2024-01-20" in keys and "batch" in keys


def test_a_stopped_run_is_made_good(spark, tmp_path, monkeypatch):
    path, counts = str(tmp_path / "clicks"), str(tmp_path / "counts")
    clicks = ingest.with_event_date(testdata.silver_tables(spark, SF)["clicks"])
    ingest.overwrite_batch(clicks, path, 0, ingest.DAY)
    with monkeypatch.context() as m:
        m.setattr(versions, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            incremental.update_counts(spark, {"clicks": path}, counts)
    incremental.update_counts(spark, {"clicks": path}, counts)
    got = incremental.read_counts(spark, counts, "clicks").agg(F.sum("events")).first()[0]
    assert got == stage_all({"clicks": clicks.drop("event_date")})["clicks"].count()


def _frame(spark, path):
    return spark.read.parquet(path).groupBy((F.col("id") % 3).alias("k")).agg(F.sum("id").alias("s"))


def test_a_hit_reads_the_stored_rows_alone(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "results")
    spark.range(100).write.parquet(source)
    first = results.cached(_frame(spark, source), root)
    asked = _frame(spark, source)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hit", "asking again")
    again = results.cached(asked, root)
    assert all(root in f for f in again.inputFiles())
    assert not tracker.getJobIdsForGroup("hit")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(first) == rows(again) == rows(_frame(spark, source))
    assert len(os.listdir(root)) == 1


def test_changes_and_age(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "results")
    spark.range(100).write.parquet(source)
    old = results.cached(_frame(spark, source), root)
    # Too old: stored again; the reader of the first keeps it.
    results.cached(_frame(spark, source), root, timedelta(0))
    key = results.result_key(_frame(spark, source))
    assert versions.current(spark, f"{root}/{key}").number == 2
    # Another source, another question.
    spark.range(5).write.mode("append").parquet(source)
    new = results.cached(_frame(spark, source), root)
    assert rows(new) == rows(_frame(spark, source)) != rows(old)
    other = results.cached(_frame(spark, source).filter("k > 0"), root)
    assert other.count() == 2 and len(os.listdir(root)) == 3
    assert results.sweep(spark, root, timedelta(hours=1)) == 0
    assert results.sweep(spark, root, timedelta(0)) == 3 and os.listdir(root) == []


def test_wide_plans_differ_in_their_last_column(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    wide = lambda last: spark.read.parquet(source).select(*[F.lit(i).alias(f"c{i}") for i in range(60)], (F.col("id") + last).alias("x"))
    assert results.result_key(wide(1)) == results.result_key(wide(1)) != results.result_key(wide(2))


def test_rows_of_the_driver_are_not_kept(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    assert results.result_key(df) is None
    assert results.cached(df, str(tmp_path)) is df and os.listdir(tmp_path) == []
