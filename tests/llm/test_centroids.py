"""Clustering against plain rounds over all vectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from check_oracle import actual, connect, expected

from adlake.llm import centroids, oracles, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, cluster int"


def _plain(rows, k=8, rounds=10):
    """rows are (vec_id, whole numbers)."""
    name = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    means = [list(v) for _, v in sorted(rows, key=lambda r: (name(r), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))
    for _ in range(rounds):
        held = {}
        for _, v in rows:
            held.setdefault(near(v)[1], []).append(v)
        for c, members in held.items():
            means[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *near(v)[::-1]) for i, v in rows]
    total = sum(d for *_, d in found)
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    own = {c: sum(d for _, e, d in found if e == c) for c in range(len(means))}
    return sorted(((i, c, d, own[c], total, digest[c]) for i, c, d in found), key=str)


def _vectors(n, d, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, d))
    return [(i, [float(x) for x in middles[rng.integers(12)] + spread * rng.normal(size=d)]) for i in range(n)]


def _found(spark, rows, dimensions, **how):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    whole = centroids.whole_vectors(df, dimensions)
    plain = [(r["vec_id"], r["whole"]) for r in whole.collect()]
    return sorted(map(tuple, centroids.cluster(whole, **how).collect()), key=str), plain


@pytest.mark.parametrize("seed, spread", [(1, 0.02), (2, 0.5), (3, 3.0)])
def test_against_plain_rounds(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(centroids, "BLOCK", 32)
    rows = _vectors(400, 6, seed, spread)
    got, plain = _found(spark, rows, 6)
    assert got == _plain(plain)


def test_bounds_spare_vectors(spark):
    """Tight clusters far apart are hardly compared after the first rounds."""
    report = []
    df = spark.createDataFrame([(i, v, 0) for i, v in _vectors(600, 64, 4, 0.01)], SCHEMA)
    centroids.cluster(centroids.whole_vectors(df), report=report).collect()
    assert report[0][1:] == (600, 0, 600)
    assert all(scanned == 0 for _, _, _, scanned in report[-3:])


def test_loosening_is_sound_and_smaller():
    """No point of a sphere comes nearer to a moved centroid than the bound says."""
    rng = np.random.default_rng(5)
    smaller = 0
    for _ in range(300):
        d = int(rng.integers(2, 6))
        before = rng.integers(-300, 300, (4, d))
        after = before + rng.integers(-40, 40, (4, d))
        radius = rng.uniform(0, 120, 4)
        bound = centroids.loosening(before, after, radius)
        for i in range(4):
            off = rng.normal(size=(200, d))
            x = before[i] + off / np.linalg.norm(off, axis=1)[:, None] * radius[i] * rng.uniform(0.7, 1, (200, 1))
            for j in range(4):
                nearer = np.linalg.norm(x - before[j], axis=1) - np.linalg.norm(x - after[j], axis=1)
                assert nearer.max() <= bound[i, j]
                smaller += bound[i, j] < 0.9 * np.linalg.norm(after[j] - before[j])
    assert smaller > 1000


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (2, None), (3, [1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [-0.5, 0.1]), (8, []), (None, [0.1, 0.1]), (1, [0.5, 0.25])]
    got, plain = _found(spark, rows, 2)
    assert sorted(str(i) for i, _ in plain) == ["1", "1", "7", "None"]
    assert got == _plain(plain)


def test_ties_equal_vectors_and_empty(spark):
    """Equal vectors all go to the first centroid; the others stay empty where they are."""
    got, plain = _found(spark, [(i, [0.5, 0.5]) for i in range(30)], 2)
    assert got == _plain(plain) and {r[1] for r in got} == {0}
    got, plain = _found(spark, [(i, [float(i % 3), 0.0]) for i in range(40)], 2, k=5)
    assert got == _plain(plain, k=5)
    assert _found(spark, [(1, [0.5])], 2)[0] == []


def test_too_large_components_stop(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], 0)], SCHEMA)
    with pytest.raises(Exception, match="distances exceed a long"):
        centroids.cluster(centroids.whole_vectors(df, 2)).collect()


def test_query_equals_sql(spark):
    want = expected(connect(SF), oracles.oracle_sql()["op13_centroids"])
    assert actual(queries.op13_centroids(spark, SF)) == want
