"""History features as they stood before each impression, and running totals per key."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import oracle_queries as oracle
from adlake.operators.ordered import running_totals_by
from adlake.plans import features as feat
from check_oracle import actual, expected
from helpers import rows, staged_frames
from test_plans import con, raw, rounded, with_parts  # noqa: F401

@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


START = datetime(2024, 1, 1)
LOG = "impression_id long, user_id int, campaign_id int, timestamp timestamp"
CLICKS = "click_id long, user_id int, campaign_id int, timestamp timestamp"


def _random_logs(n, seed):
    """Few moments, so that many events tie; one campaign holds two thirds of all rows."""
    rng = random.Random(seed)

    def event(ids):
        when = None if rng.random() < 0.05 else START + timedelta(minutes=rng.randrange(60))
        return (rng.randrange(ids), rng.randrange(12), rng.choice((1, 1, 1, 1, 2, 3)), when)

    return [event(n) for _ in range(n)], [event(n // 4) for _ in range(n // 3)]


def _plain(log, clicks):
    out = []
    for i, user, campaign, at in log:
        rate = history = None
        if at is not None:
            clicked = {(u, c) for _, u, c, t in clicks if t is not None and t < at}
            seen = {(u, c) for _, u, c, t in log if t is not None and t < at}
            mine = [(j, c) for j, u, c, t in log if u == user and t is not None and t < at and (u, c) in clicked]
            if mine:
                rate = len({c for _, c in mine}) / len({j for j, _ in mine})
            shown = {j for j, _, c, t in log if c == campaign and t is not None and t < at}
            hits = {k for k, u, c, t in clicks if c == campaign and t is not None and t < at and (u, c) in seen}
            if shown:
                history = len(hits) / len(shown)
        out.append((i, user, campaign, at, rate, history))
    return sorted(out, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("seed, partitions", [(1, 4), (2, 1), (3, 16)])
def test_history_against_plain_counts(spark, seed, partitions):
    """Also where a hot campaign lies in several ranges."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        log, clicks = _random_logs(400, seed)
        shown = spark.createDataFrame(log, LOG)
        hits = spark.createDataFrame(clicks, CLICKS)
        joined = feat._click_log({"impressions": shown, "clicks": hits})
        got = feat.history_as_of(joined, hits).select(
            "impression_id", "user_id", "campaign_id", "impression_time", "user_click_rate", "campaign_ctr_history"
        )
        assert rows(got) == _plain(log, clicks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_campaign_lies_in_several_ranges(spark):
    """One key, no distinct order but the time: the ranges share it, the totals go on."""
    df = spark.range(20_000).select(F.lit(7).alias("k"), "id", F.lit(1).alias("v"))
    out = running_totals_by(df, "k", ["id"], {"n": "v"})
    assert out.filter("n <> id + 1").count() == 0 and out.count() == 20_000
    spread = df.repartitionByRange("k", "id").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1


def test_running_totals_by_key(spark):
    rng = random.Random(4)
    data = [(rng.choice((None, 1, 1, 1, 1, 2)), i, rng.choice((None, 0, 1, 5)), -i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, at long, v long, w long")
    got = running_totals_by(df, "k", ["at"], {"sv": "v", "sw": F.col("w") * 2})
    assert got.columns == ["k", "at", "v", "w", "sv", "sw"]
    totals, want = {}, []
    for k, at, v, w in data:
        a, b = totals.get(k, (0, 0))
        totals[k] = a + (v or 0), b + 2 * w
        want.append((k, at, v, w, *totals[k]))
    assert rows(got) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert running_totals_by(df.limit(0), "k", ["at"], {"s": "v"}).count() == 0


def test_nothing_from_the_moment_itself_or_later(spark):
    """The only events are the impression's own, of its very moment, and later ones."""
    later = START + timedelta(hours=1)
    log = [(1, 1, 1, START), (2, 2, 1, START), (3, 1, 1, later)]
    clicks = [(1, 1, 1, START), (2, 2, 1, later)]
    shown, hits = spark.createDataFrame(log, LOG), spark.createDataFrame(clicks, CLICKS)
    out = feat.history_as_of(feat._click_log({"impressions": shown, "clicks": hits}), hits)
    found = {r["impression_id"]: (r["user_click_rate"], r["campaign_ctr_history"]) for r in out.collect()}
    assert found == {1: (None, None), 2: (None, None), 3: (1.0, 0.5)}


def test_training_set_as_of(spark, con):  # noqa: F811
    sql = with_parts(
        "select * exclude (budget, user_click_rate, campaign_ctr_history), "
        + oracle.r6("budget", "user_click_rate", "campaign_ctr_history")
        + " from training_before",
        oracle.STAGED, oracle.TRAINING, oracle.AS_OF_TRAINING,
    )
    want = expected(con, sql)
    assert len(want[1]) > 30
    assert actual(rounded(feat.training_set_as_of(staged_frames(spark)))) == want
