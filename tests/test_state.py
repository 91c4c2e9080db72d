"""Silver by remembered digests: the same rows as cleaning all records at once."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adlake.plans.silver import silver
from adlake.sources import landing, testdata
from adlake.streaming import ingest
from helpers import rows

SF = "/root/testdata/sf0.001"


def sale(i, when, revenue="1"):
    time = f', "timestamp": "{when}"' if when else ""
    return f'{{"conversion_id": "{i}", "revenue": "{revenue}"{time}}}'


class Feed:
    """Files that arrive one run after the other, at given times."""

    def __init__(self, spark, tmp_path, entity, **how):
        self.spark, self.entity, self.how, self.count = spark, entity, how, 0
        self.topic, self.out, self.checkpoint = (str(tmp_path / n) for n in ("topic", "silver", "c"))
        os.mkdir(self.topic)
        self.read_back = []

    def bring(self, clock, *lines):
        """One file, one run; notes how often stored rows were looked up."""
        with open(f"{self.topic}/{self.count}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        self.count += 1
        bronze = landing.to_bronze(landing.stream_messages(self.spark, self.topic, "text"))
        plain, looked = ingest.read_folder, []
        ingest.read_folder = lambda spark, path, schema: looked.append(path) or plain(spark, path, schema)
        try:
            how = {"clock": F.lit(datetime.fromisoformat(clock)), **self.how} if clock else self.how
            ingest.stream_silver_by_state(bronze, self.entity, self.out, self.checkpoint, **how)
        finally:
            ingest.read_folder = plain
        self.read_back.append(len(looked))

    def check(self):
        got = rows(ingest.read_silver(self.spark, self.entity, self.out))
        every = landing.to_bronze(self.spark.read.text(self.topic))
        assert got == rows(silver(every, self.entity))
        return got


def test_recent_days_are_not_read_back(spark, tmp_path):
    feed = Feed(spark, tmp_path, "conversions")
    feed.bring("2024-01-05 12:00:00", sale(1, "2024-01-05 10:00:00"), sale(1, "2024-01-05 10:00:00"))
    # A day of its own, a copy of yesterday's, and one that differs in its revenue alone.
    feed.bring("2024-01-06 12:00:00", sale(2, "2024-01-06 10:00:00"), sale(1, "2024-01-05 10:00:00"), sale(1, "2024-01-05 10:00:00", "2"))
    feed.bring("2024-01-07 09:00:00", sale(3, "2024-01-07 08:00:00"), sale(1, "2024-01-05 10:00:00"))
    assert feed.read_back == [0, 0, 0]
    assert len(feed.check()) == 4


def test_old_and_timeless_rows_are_compared(spark, tmp_path):
    feed = Feed(spark, tmp_path, "conversions", horizon_hours=24)
    feed.bring("2024-01-05 12:00:00", sale(1, "2024-01-05 10:00:00"), sale(9, None), sale(8, "2023-12-01 00:00:00"))
    # The digests of January go with the first batch after their time, this one.
    feed.bring("2024-03-01 12:00:00", sale(1, "2024-01-05 10:00:00"), sale(4, "2024-03-01 11:00:00"))
    feed.bring("2024-05-01 12:00:00", sale(1, "2024-01-05 10:00:00"), sale(9, None), sale(8, "2023-12-01 00:00:00"))
    assert feed.read_back[0] and feed.read_back[2]
    assert len(feed.check()) == 4


def test_events_of_the_future(spark, tmp_path):
    """A copy that comes when the event is no longer ahead, and the state forgot the first."""
    feed = Feed(spark, tmp_path, "conversions", horizon_hours=24)
    ahead = sale(1, "2024-06-01 10:00:00")
    feed.bring("2024-01-05 12:00:00", ahead)
    feed.bring("2024-04-01 12:00:00", sale(2, "2024-04-01 11:00:00"))
    feed.bring("2024-05-01 12:00:00", sale(3, "2024-05-01 11:00:00"))
    feed.bring("2024-06-01 12:00:00", ahead, sale(4, "2024-06-01 10:00:00"))
    assert len(feed.check()) == 4


def test_entities_without_a_time(spark, tmp_path):
    feed = Feed(spark, tmp_path, "users")
    feed.bring(None, '{"user_id": "1", "region": " US "}', '{"user_id": "1", "region": "us"}', "broken")
    feed.bring(None, '{"user_id": "1", "region": "us "}', '{"user_id": "2"}', "broken too")
    feed.bring(None, '{"user_id": "2", "region": null}', '{"region": "2"}')
    assert feed.read_back == [0, 0, 0]
    assert len(feed.check()) == 4


@pytest.mark.parametrize("entity, clock", [("clicks", "2024-01-20 00:00:00"), ("campaigns", None)])
def test_sample_records_in_several_runs(spark, tmp_path, entity, clock):
    feed = Feed(spark, tmp_path, entity, horizon_hours=120)
    records = [r[0] for r in testdata.bronze_records(spark, SF, entity).collect()]
    for part in range(3):
        feed.bring(clock, *records[part::3], *records[:5])
    assert len(feed.check()) > 100


def test_a_stopped_batch_is_taken_again(spark, tmp_path, monkeypatch):
    """The run stops after the rows are written and before the batch is done."""
    feed = Feed(spark, tmp_path, "conversions")
    feed.bring("2024-01-05 12:00:00", sale(1, "2024-01-05 10:00:00"))
    written = ingest.overwrite_batch

    def stop(*args):
        written(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(ingest, "overwrite_batch", stop)
    with pytest.raises(Exception, match="stopped"):
        feed.bring("2024-01-06 12:00:00", sale(2, "2024-01-06 10:00:00"), sale(1, "2024-01-05 10:00:00"))
    monkeypatch.setattr(ingest, "overwrite_batch", written)
    feed.bring("2024-01-06 13:00:00", sale(2, "2024-01-06 10:00:00"), sale(3, "2024-01-06 10:00:00"))
    assert len(feed.check()) == 3


def test_digests_tell_rows_apart(spark):
    data = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, None), ("a", None, -0.0), ("", "a", 0.0), ("", None, 0.0), (None, None, 0.0)]
    df = spark.createDataFrame(data, "x string, y string, z double")
    found = [r[0] for r in df.select(ingest.row_digest(df)).collect()]
    assert len(set(found)) == 6 and found[1] == found[3] and {len(f) for f in found} == {32}


def test_batches_store_changes_of_the_state(spark, tmp_path):
    """Not a copy of the state for each batch; the settings of the session stay as they were."""
    feed = Feed(spark, tmp_path, "conversions")
    before = [spark.conf.get(k, None) for k in ingest._STATE]
    feed.bring("2024-01-05 12:00:00", sale(1, "2024-01-05 10:00:00"))
    feed.bring("2024-01-06 12:00:00", sale(2, "2024-01-06 10:00:00"), sale(1, "2024-01-05 10:00:00"))
    assert [spark.conf.get(k, None) for k in ingest._STATE] == before
    names = [n for _, _, files in os.walk(f"{feed.checkpoint}/state") for n in files]
    assert any(n.endswith(".changelog") for n in names)
    assert len(feed.check()) == 2


def test_parts_of_the_state_follow_the_cores(spark, tmp_path):
    """However many partitions a shuffle has; a later run with other settings keeps the parts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    most = 2 * spark.sparkContext.defaultParallelism
    feed = Feed(spark, tmp_path, "conversions")
    spark.conf.set(key, str(most + 9))
    try:
        feed.bring("2024-01-05 12:00:00", sale(1, "2024-01-05 10:00:00"), sale(1, "2024-01-05 10:00:00"))
        assert spark.conf.get(key) == str(most + 9)
    finally:
        spark.conf.set(key, before)
    feed.bring("2024-01-06 12:00:00", sale(2, "2024-01-06 10:00:00"), sale(1, "2024-01-05 10:00:00"))
    assert len([n for n in os.listdir(f"{feed.checkpoint}/state/0") if n.isdigit()]) == most
    assert len(feed.check()) == 2
