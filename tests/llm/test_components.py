"""Connected components against union-find."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from adlake.llm.common import key_filter, with_maybe
from adlake.llm.components import components


def _expected(edges):
    root: dict = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root if find(x) != x}


def _check(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == _expected(edges)


def test_mixed_graph(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1090)]
    star = [(5000, i) for i in range(5001, 5100)]
    loose = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    _check(spark, [*chain, *star, *loose, (7, 7), (None, 3), (-5, 1050), (8, 9), (9, 8)])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_key_filter(spark):
    """False only for keys that are not held; never for those that are."""
    df = spark.range(20_000).select((F.col("id") * 7919 - 50_000_000_000).alias("k"), F.lit(1).alias("bits"))
    held = df.filter("k % 3 = 0")
    found = key_filter(held, F.col("k"))
    marked = with_maybe(df, F.col("k"), found)
    assert marked.filter("k % 3 = 0 and not _maybe").count() == 0
    assert marked.filter("k % 3 <> 0 and _maybe").count() < 50
    assert marked.count() == 20_000 and marked.select("bits").distinct().count() == 1
    none = with_maybe(df, F.col("k"), key_filter(held.limit(0), F.col("k")))
    assert none.filter("_maybe").count() == 0
