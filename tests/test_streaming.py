from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import functions as F

from adlake.plans.silver import silver
from adlake.sources import landing, testdata
from adlake.streaming import daily, ingest
from helpers import rows

SF = "/root/testdata/sf0.001"


def click(i: int, when: str) -> str:
    return f'{{"click_id": "{i}", "user_id": "1", "campaign_id": "2", "timestamp": "{when}"}}'


def put(folder, name: str, *lines: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def _clean(spark, topic, entity, tmp_path, **options):
    one = {"maxFilesPerTrigger": "1", **options}
    bronze = landing.to_bronze(landing.stream_messages(spark, str(topic), "text", one))
    ingest.stream_silver(bronze, entity, str(tmp_path / "silver"), str(tmp_path / "c"))
    return rows(ingest.read_silver(spark, entity, str(tmp_path / "silver")))


def test_several_runs_equal_one_batch(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "1.txt", click(1, "2024-01-01 10:00:00"), click(1, "2024-01-01 10:00:00"), "broken")
    first = _clean(spark, topic, "clicks", tmp_path)
    assert len(first) == 2
    assert _clean(spark, topic, "clicks", tmp_path) == first  # nothing new, nothing added
    # a copy of an earlier record and a new one
    put(topic, "2.txt", click(1, "2024-01-01 10:00:00"), click(2, "2024-01-01 11:00:00"))
    second = _clean(spark, topic, "clicks", tmp_path)
    assert second == rows(silver(landing.to_bronze(spark.read.text(str(topic))), "clicks"))
    assert len(second) == 3


def test_late_and_timeless_records(spark, tmp_path):
    """Files that go back in time, each with a copy of a record without a time."""
    topic = tmp_path / "topic"
    for number, day in enumerate((20, 15, 10, 5, 1)):
        put(
            topic,
            f"{number}.txt",
            f'{{"conversion_id": "{number}", "revenue": "1", "timestamp": "2024-01-{day:02} 10:00:00"}}',
            '{"conversion_id": "99", "revenue": "7"}',
        )
        os.utime(topic / f"{number}.txt", (1_700_000_000 + number, 1_700_000_000 + number))
    got = _clean(spark, topic, "conversions", tmp_path)
    assert got == rows(silver(landing.to_bronze(spark.read.text(str(topic))), "conversions"))
    assert len(got) == 6


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    bronze = spark.createDataFrame([(click(1, "2024-01-01 10:00:00"),)], "json_record string")
    path = str(tmp_path / "silver")
    for batch in (0, 0, 1, 1):
        ingest.append_silver(bronze, batch, path, "clicks")
    assert ingest.read_silver(spark, "clicks", path).count() == 1
    assert ingest.read_silver(spark, "clicks", str(tmp_path / "nothing")).count() == 0


def test_records_without_event_time(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "1.txt", '{"user_id": "1", "region": " US "}', '{"user_id": "1", "region": "us"}')
    put(topic, "2.txt", '{"user_id": "1", "region": "us "}', '{"user_id": "2"}')
    got = _clean(spark, topic, "users", tmp_path)
    assert got == [(1, "us", None, None, None), (2, None, None, None, None)]


def test_all_days_with_late_rows(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "days")

    def run():
        events = spark.readStream.schema("timestamp timestamp, revenue double").json(str(source))
        daily.stream_daily(events, out, str(tmp_path / "c"))
        return rows(daily.read_daily(spark, out))

    put(source, "1.json", '{"timestamp": "2024-01-05T10:00:00", "revenue": 1.5}')
    assert run() == [(date(2024, 1, 5), 1, 1.5)]
    put(source, "2.json", '{"timestamp": "2024-01-01T10:00:00", "revenue": 2}',
        '{"timestamp": "2024-01-05T23:00:00"}')
    assert run() == [(date(2024, 1, 1), 1, 2.0), (date(2024, 1, 5), 2, 1.5)]


def test_daily_totals_close_and_drop_late_rows(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")

    def run():
        events = (
            spark.readStream.schema("timestamp timestamp, revenue double")
            .json(str(source))
        )
        ingest.run_available(daily.closed_days(events, "1 hour"), out, checkpoint)
        return rows(spark.read.parquet(out))

    def event(when, revenue):
        return f'{{"timestamp": "{when}", "revenue": {revenue}}}'

    put(source, "1.json", event("2024-01-01T10:00:00", 1.5), event("2024-01-01T11:00:00", "null"),
        event("2024-01-02T00:30:00", 4))
    assert run() == []  # the watermark is still inside the first day
    put(source, "2.json", event("2024-01-01T23:59:00", 2), event("2024-01-02T12:00:00", 1))
    assert run() == [(date(2024, 1, 1), 3, 3.5)]
    put(source, "3.json", event("2024-01-01T12:00:00", 100), event("2024-01-03T02:00:00", 0))
    assert run() == [(date(2024, 1, 1), 3, 3.5), (date(2024, 1, 2), 2, 5.0)]


def test_stream_of_sample_events(spark, tmp_path):
    events = testdata.stream_events(spark, SF).filter("event_type = 'view'").selectExpr(
        "cast(ts as timestamp) as timestamp", "value as revenue"
    )
    out = str(tmp_path / "out")
    ingest.run_available(daily.closed_days(events), out, str(tmp_path / "c"))
    batch = testdata.silver_tables(spark, SF)["impressions"]
    last = batch.agg(F.max("timestamp")).first()[0]
    want = {
        r[0]: r[1]
        for r in batch.groupBy(F.to_date("timestamp")).count().collect()
        if (last - datetime(r[0].year, r[0].month, r[0].day)).total_seconds() >= 25 * 3600
    }
    assert {r["day"]: r["events"] for r in spark.read.parquet(out).collect()} == want


def test_event_date_column(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3),)], "timestamp timestamp")
    assert ingest.with_event_date(df).first()["event_date"] == date(2024, 1, 2)
