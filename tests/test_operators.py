from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.operators import ordered, quality, sampling
from helpers import rows


def test_adaptive_execution_splits_a_hot_key(spark):
    """The one mechanism against hot keys in joins: no task gets a whole hot key."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        # One key holds most rows; their payload does not compress.
        rows_ = spark.range(60_000).repartition(6).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 512).alias("text"),
        )
        joined = rows_.join(spark.range(60_000).withColumnRenamed("id", "k"), "k")
        assert joined.groupBy().agg(F.count("text")).first()[0] == 60_000
        # Of the text too, as a lone constant key would take no room.
        counted = joined.groupBy(F.spark_partition_id()).agg(
            F.count("text").alias("count"), F.max("text")
        )
        assert counted.agg(F.max("count")).first()[0] < 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_total(spark):
    random.seed(2)
    data = [(random.choice([5.0, 1.0, 2.5]), f"a{i}", random.randrange(4)) for i in range(300)]
    df = spark.createDataFrame(data, "x double, name string, n int").repartition(5)
    got = ordered.running_total(df, [F.desc("x"), "name"], "n", "upto").collect()
    want, total = {}, 0
    for x, name, n in sorted(data, key=lambda r: (-r[0], r[1])):
        total += n
        want[name] = total
    assert {r["name"]: r["upto"] for r in got} == want
    assert len(got) == 300


def test_running_total_of_nothing(spark):
    df = spark.createDataFrame([], "x double, n int")
    assert ordered.running_total(df, ["x"], "n", "upto").collect() == []


def test_exact_quantiles(spark):
    random.seed(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    groups = {
        "ties": [random.choice([1.0, 2.0, 2.0, 9.0]) for _ in range(101)],
        "spread": [random.random() for _ in range(58)],
        "single": [4.0],
    }
    data = [(g, v) for g, values in groups.items() for v in values]
    data += [("ties", None), (None, 3.0), ("void", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    got = {(r["g"], r["prob"]): r["quantile"] for r in ordered.exact_quantiles(df, "v", probs, "g").collect()}
    assert len(got) == 3 * len(probs)
    for g, values in groups.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(values, p), abs=1e-12)
    everything = [v for _, v in data if v is not None]
    whole = {r["prob"]: r["quantile"] for r in ordered.exact_quantiles(df, "v", probs).collect()}
    assert whole == {p: pytest.approx(np.quantile(everything, p), abs=1e-12) for p in probs}


def test_exact_quantiles_with_a_hot_group(spark, no_broadcast):
    data = [("a", float(i)) for i in range(50)] + [("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r["g"], r["prob"]): r["quantile"] for r in ordered.exact_quantiles(df, "v", [0.5], "g").collect()}
    assert got == {("a", 0.5): 24.5, ("b", 0.5): 1.5}


def test_top_n_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 5.0), (4, 7.0)], "id int, m double")
    assert [r["id"] for r in ordered.top_n(df, 3, "m", "id").collect()] == [4, 2, 3]
    assert [r["id"] for r in ordered.top_n(df, 9, "m", "id").collect()] == [4, 2, 3, 1]


def test_share_of_total(spark):
    df = spark.createDataFrame([(1, 1), (2, 3)], "id int, n int")
    got = rows(ordered.share_of_total(df, "n", "pct", 100.0))
    assert got == [(1, 1, 25.0), (2, 3, 75.0)]
    zero = spark.createDataFrame([(1, 0)], "id int, n int")
    assert ordered.share_of_total(zero, "n", "pct").first()["pct"] is None


@pytest.mark.parametrize("fraction", [0.2, 0.5, 0.0, 1.0])
def test_stratified_split_is_exact(spark, fraction):
    data = [(i, int(i % 9 == 0)) for i in range(501)]
    df = spark.createDataFrame(data, "id long, y int").repartition(6)
    got = sampling.stratified_split(df, "y", "id", fraction).collect()
    assert len(got) == 501

    sizes = Counter(y for _, y in data)
    want_rows = math.ceil(501 * fraction)
    quota = {y: math.floor(want_rows * n / 501) for y, n in sizes.items()}
    rest = sorted(sizes, key=lambda y: (-(want_rows * sizes[y] / 501 - quota[y]), y))
    for y in rest[: want_rows - sum(quota.values())]:
        quota[y] += 1
    expected = set()
    for y in sizes:
        ids = [i for i, label in data if label == y]
        ids.sort(key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))
        expected |= set(ids[: quota[y]])
    assert {r["id"] for r in got if r["is_test"]} == expected


def test_stratified_split_changes_with_the_seed(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)], "id long, y int")
    parts = [
        {r["id"] for r in sampling.stratified_split(df, "y", "id", 0.2, s).filter("is_test").collect()}
        for s in (1, 2, 1)
    ]
    assert parts[0] != parts[1] and parts[0] == parts[2]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(quality.not_unique(df, "id")) == [(1, 2)]
    assert quality.null_rows(df, "id").count() == 2
    report = quality.check_report({"t": df}, [("t", "id", "unique"), ("t", "id", "not_null")])
    assert rows(report) == [("t", "id", "not_null", 2), ("t", "id", "unique", 1)]
