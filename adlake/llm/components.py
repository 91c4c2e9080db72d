"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adlake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.inline(ends))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects a > b in every edge, and every edge once."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # The edge to the smallest stays, the other end of every other edge moves to it.
    moved = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    return edges.join(least, "a").select(moved.alias("a"), F.col("m").alias("b")).distinct()


def _stored_with_state(edges: DataFrame) -> tuple[DataFrame, dict]:
    """``edges`` stored, with their number and the sum of their hashes, taken as they are written."""
    seen = Observation()
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    kept = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h")), "edges")
    return kept, seen.get


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (a, b) that is not a smallest one.

    ``component`` is the smallest node reachable; nodes without a smaller one are left
    out. Each round links every node to the smallest of its neighbours, first among the
    larger ones and then among the smaller ones, until all edges point at a root, which
    takes a number of rounds logarithmic in the longest path. Only minima are gathered
    per node, so a node with very many edges needs no list of them. Self loops and nulls
    are ignored; an empty input gives an empty result.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    current, state = _stored_with_state(
        edges.filter("a is not null and b is not null and a <> b")
        .select(high.alias("a"), low.alias("b"))
        .distinct()
    )
    for _ in range(max_rounds):
        # Stored apart: in one plan with the small star, the driver plans the large one again and again.
        large = stored(_large_star(current), "edges")
        current, following = _stored_with_state(_small_star(large))
        if state == following:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = following
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
