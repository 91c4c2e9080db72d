"""The driver's work: plans that stay short, however many steps and passes an operator takes."""

from __future__ import annotations

import random
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import functions as F

from adlake.llm import common, components, mixing, simhash


@contextmanager
def _written(monkeypatch) -> Iterator[list[int]]:
    """Per stored table the number of shuffles and scans of its plan."""
    sizes = []

    def kept(df, name="stage"):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        sizes.append((plan.count("Exchange "), plan.count("FileScan")))
        return common.stored(df, name)

    with monkeypatch.context() as patch:
        for module in (components, mixing, simhash):
            patch.setattr(module, "stored", kept)
        yield sizes


def test_no_plan_of_the_mix_holds_all_its_steps(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, f"s{i % 3}", " ".join("w" for _ in range(rng.randrange(40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    with _written(monkeypatch) as sizes:
        mixed = mixing.mix(docs, shard_docs=20)
        mixing.stored(mixed)
    assert max(shuffles for shuffles, _ in sizes) <= 12
    assert mixed.agg(F.sum("taken")).first()[0] > 0


def test_rounds_of_components_scan_their_edges_twice(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with _written(monkeypatch) as sizes:
        found = components.components(edges)
    assert max(sizes[1:]) <= (6, 2)
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(1, 41)}


def test_links_scan_all_passes_at_once(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, *[rng.getrandbits(64) - (1 << 63) for _ in range(13)]) for i in range(20)]
    df = spark.createDataFrame(rows, "node long, " + ", ".join(f"_fp{k} long" for k in range(13)))
    with _written(monkeypatch) as sizes:
        simhash.stored(simhash.links(df, simhash.APART, simhash.set_segments(1), 13, simhash.CARRIED))
    assert max(scans for _, scans in sizes) <= 8
