"""Operators that keep something per day: digests of keys and sketches of values."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from adlake.operators import daily_keys, sketches
from adlake.operators.quality import not_unique
from helpers import rows

D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))


def _log(spark, path, data):
    df = spark.createDataFrame(data, "id long, event_date date")
    df.withColumn("kind", F.lit("x")).write.mode("overwrite").partitionBy("event_date").parquet(path)
    return spark.read.schema("id long, kind string, event_date date").parquet(path)


def test_repeats_within_and_across_days(spark, tmp_path):
    data = [(1, D1), (1, D1), (2, D1), (3, D1), (2, D2), (4, D2), (None, D1), (None, D2), (5, D3), (6, None), (5, None), (7, None), (7, None)]
    log, root = _log(spark, str(tmp_path / "log"), data), str(tmp_path / "keys")
    assert daily_keys.repeated_keys(log, "id", root).count() == 0
    for days in ([D1], [D2], [D3], [None]):
        daily_keys.check_days(log, "id", root, days)
        taken = log.filter(daily_keys._of_days([D1, D2, D3, None][: [[D1], [D2], [D3], [None]].index(days) + 1]))
        assert rows(daily_keys.repeated_keys(log, "id", root)) == rows(not_unique(taken, "id"))
    assert rows(daily_keys.repeated_keys(log, "id", root)) == [(1, 2), (2, 2), (5, 2), (7, 2)]


def test_a_day_taken_again(spark, tmp_path):
    """Late rows bring a repeat of another day."""
    path, root = str(tmp_path / "log"), str(tmp_path / "keys")
    log = _log(spark, path, [(1, D1), (2, D2)])
    daily_keys.check_days(log, "id", root, [D1, D2])
    assert daily_keys.repeated_keys(log, "id", root).count() == 0
    log = _log(spark, path, [(1, D1), (2, D2), (1, D2), (3, D2)])
    for _ in range(2):
        daily_keys.check_days(log, "id", root, [D2])
        assert rows(daily_keys.repeated_keys(log, "id", root)) == [(1, 2)]


def test_digests_that_meet_by_chance(spark, tmp_path, monkeypatch):
    """Different keys of one digest are no repeats."""
    log, root = _log(spark, str(tmp_path / "log"), [(i, D1 if i % 2 else D2) for i in range(40)] + [(3, D3)]), str(tmp_path / "keys")
    monkeypatch.setattr(daily_keys.F, "xxhash64", lambda c: F.pmod(F.col(c) if isinstance(c, str) else c, F.lit(7)).cast("long"))
    for day in (D1, D2, D3):
        daily_keys.check_days(log, "id", root, [day])
    assert rows(daily_keys.repeated_keys(log, "id", root)) == [(3, 2)]


def test_other_days_are_not_read(spark, tmp_path):
    log, root = _log(spark, str(tmp_path / "log"), [(1, D1), (2, D2), (2, D2), (3, D3)]), str(tmp_path / "keys")
    daily_keys.check_days(log, "id", root, [D1, D2, D3])
    plan = daily_keys.repeated_keys(log, "id", root)._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-02" in plan and "2024-01-01" not in plan


@pytest.mark.parametrize("n", [50, 40_000])
def test_quantiles_of_days_merged(spark, n):
    rng = random.Random(n)
    data = [(rng.randint(1, 9), rng.choice("ab"), rng.choice((None, float("nan"), rng.gauss(0, 5), float(rng.randint(0, 3))))) for _ in range(n)]
    df = spark.createDataFrame(data, "day int, k string, v double")
    kept = sketches.value_sketches(df, "v", ["day", "k"])
    assert kept.columns == ["day", "k", "n", "sketch"]
    found = sketches.sketched_quantiles(kept.filter("day between 2 and 6"), (0.0, 0.1, 0.5, 0.9, 1.0), ["k"]).collect()
    assert len(found) == 10
    for r in found:
        values = sorted(v for d, k, v in data if k == r["k"] and 2 <= d <= 6 and v is not None and v == v)
        assert r["n"] == len(values) and r["quantile"] in values
        low = sum(v < r["quantile"] for v in values) / len(values)
        high = sum(v <= r["quantile"] for v in values) / len(values)
        error = sketches.RANK_ERROR if n > sketches.SIZE else 1 / len(values)
        assert low - error <= r["prob"] <= high + error


def test_no_values(spark):
    df = spark.createDataFrame([(1, None)], "day int, v double")
    kept = sketches.value_sketches(df, "v", ["day"])
    assert kept.count() == 0 and sketches.sketched_quantiles(kept, (0.5,)).count() == 0
