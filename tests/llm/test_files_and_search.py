"""WARC archives and exact top-k against plain Python."""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from adlake.llm import topk, warc
from adlake.llm.common import table
from adlake.session import work_path

SF = "/root/testdata/sf0.01"


def _round_trip(spark, pages, **how):
    root = work_path(spark, "warc")
    manifest = warc.write_warc(pages, root, **how)
    return manifest.collect(), warc.read_warc(manifest, root).collect()


def _expected(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for page, html in rows:
        d = digest(html)
        if page is not None:
            first[d] = min(page, first.get(d, page))
    answered, out = set(), []
    for page, html in rows:
        d = digest(html)
        answers = page == first.get(d) and d not in answered
        if answers:
            answered.add(d)
        kind, target = ("response", None) if answers else ("revisit", first.get(d))
        out.append((page, len((html or "").encode()), d, kind, target))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [64 << 20, 20_000])
def test_warc_of_the_table(spark, limit):
    pages = table(spark, SF, "pages")
    manifest, rows = _round_trip(spark, pages, file_bytes=limit)
    assert sorted(map(tuple, rows), key=str) == _expected([(r["page_id"], r["html"]) for r in pages.collect()])
    assert len(manifest) > 10 or limit > 1e6
    again, _ = _round_trip(spark, pages, file_bytes=limit)
    assert sorted(r["sha256"] for r in manifest) == sorted(r["sha256"] for r in again)


def test_warc_of_odd_rows(spark):
    rows = [(3, "u", "same"), (2, None, "same"), (2, None, "same"), (None, "x y\n", "same"), (5, "u", None), (4, "u", ""), (9, "é", "ü\r\n\r\n" * 9)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string")
    _, got = _round_trip(spark, df)
    assert sorted(map(tuple, got), key=str) == _expected([(p, h) for p, _, h in rows])
    assert _round_trip(spark, df.limit(0)) == ([], [])


def test_only_accepted_attempts_are_committed(spark):
    root = work_path(spark, "warc")
    fs, path = warc._filesystem(root)
    stray = warc._Roller(root, 0, 1 << 20)
    stray.add(b"left over by a lost attempt")
    manifest = warc.write_warc(table(spark, SF, "pages").limit(9), root)
    assert warc.read_warc(manifest, root).count() == 9


def _best(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_of_the_table(spark):
    raw = table(spark, SF, "embeddings")
    vectors = [(r["vec_id"], [math.floor(64 * float(x)) for x in r["embedding"]]) for r in raw.collect()]
    q = topk.quantized(raw)
    got = topk.top_k(q, q.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, got)) == _best(vectors, [v for v in vectors if v[0] % 20 == 0], 20)


def test_topk_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)], "t") for i in range(60)]
    rows += [(60, None, "t"), (61, [1.0, None, 0.0, 0.0], "t"), (62, [float("nan")] * 4, "t"), (63, [float("inf")] * 4, "t"), (None, [1.0] * 4, "t"), (5, [1.0, 2.0, 3.0, 1.0], "t")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    q = topk.quantized(df)
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if i is not None and i < 60]
    got = topk.top_k(q, q.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted(map(tuple, got)) == _best(sound, [s for s in sound if s[0] % 20 == 0], 20)
    few = q.filter("vec_id < 4")
    assert topk.top_k(few, few.filter("vec_id = 0"), 20).count() == 3
    assert topk.top_k(q.limit(0), q.limit(0)).count() == 0


def test_topk_of_repeated_queries_and_lengths(spark):
    """Each row of a query id has ranks of its own; shorter vectors are compared in what they have."""
    rows = [(20, [1, 0, 0]), (20, [0, 1, 0]), (1, [5, 1, 7]), (2, [1, 5]), (3, [2]), (4, []), (40, [0, 0, 1, 9])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), 2).collect()
    pad = lambda v: v + [0] * (4 - len(v))
    want = []
    for q, v in (r for r in rows if r[0] % 20 == 0):
        want += _best([(i, pad(x)) for i, x in rows], [(q, pad(v))], 2)
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_has_no_task_for_each_pair_of_blocks(spark, monkeypatch):
    """Tasks grow with the candidates only, and what tasks are sent at a time is bounded."""
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 8)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    monkeypatch.setattr(topk, "SENT_VALUES", 200, raising=False)
    rng = np.random.default_rng(6)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    dealt, repartition = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *a: dealt.append(n) or repartition(self, n, *a))
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: sent.append(len(v[0])) or broadcast(self, v))
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == _best(rows, rows[::20], 5)
    # 50 blocks of candidates, 10 blocks of queries.
    assert max(dealt, default=0) <= 50
    assert sum(sent) == 20


def test_archives_are_read_by_tasks_of_their_own(spark):
    pages = table(spark, SF, "pages")
    root = work_path(spark, "warc")
    manifest = warc.write_warc(pages, root, file_bytes=1 << 14)
    files = manifest.count()
    assert files > 3
    assert warc.read_warc(manifest, root).rdd.getNumPartitions() == files


def test_search_stops_early():
    rng = np.random.default_rng(2)
    far = rng.integers(-64, 64, (20000, 3)).astype(np.int64)
    assert isinstance(pa.array(far[:, 0]), pa.Array)
    squares = (far.astype(float) ** 2).sum(1)
    most = squares.max()
    rows = topk._augmented(far, squares, most, False)
    pivots = rows[:32]
    q = far[:1]
    table_x, table_q = topk._distances(rows, pivots), topk._distances(topk._augmented(q, None, most, True), pivots)
    ids, scores = topk._search(q, np.array([0]), np.array([9]), table_q, far, np.arange(len(far)), table_x, squares, most, 5)[2:]
    exact = far @ q[0]
    exact[0] = -(10**9)
    assert list(scores) == sorted(exact, reverse=True)[:5]


def _block(v, n_queries, k, ids=None):
    """One search block over v with its first rows as queries, and what it should give."""
    ids = np.arange(len(v)) if ids is None else ids
    squares = (v.astype(float) ** 2).sum(1)
    most = squares.max()
    rows, q = topk._augmented(v, squares, most, False), v[:n_queries]
    t = topk._distances(rows, rows[:32])
    t_q = topk._distances(topk._augmented(q, None, most, True), rows[:32])
    got = topk._search(q, ids[:n_queries], np.arange(n_queries) + 5, t_q, v, ids, t, squares, most, k)
    want = []
    for i, x in enumerate(q.tolist()):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), n) for n, y in zip(ids.tolist(), v.tolist()) if n != ids[i])
        want += [(i + 5, int(ids[i]), n, -s) for s, n in scored[:k]]
    return list(zip(*(c.tolist() for c in got))), want


def test_search_works_by_tiles_not_by_query(monkeypatch):
    """Each tile is ranked once for all queries of the block, not once for every query."""
    v = np.random.default_rng(3).integers(-40, 41, (2000, 16)).astype(np.int64)
    calls, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda *a, **k: calls.append(1) or lexsort(*a, **k))
    got, want = _block(v, 100, 7)
    assert got == want
    assert len(calls) <= 2000 / topk.STEP + 2


def test_search_of_clusters_ties_and_large_values(monkeypatch):
    monkeypatch.setattr(topk, "STEP", 16)
    rng = np.random.default_rng(4)
    ties = rng.integers(0, 2, (300, 3)).astype(np.int64)
    groups = (rng.integers(0, 5, 400)[:, None] * np.array([[700, -300, 50]]) + rng.integers(-3, 4, (400, 3))).astype(np.int64)
    for v in (ties, groups, groups * 3000, groups * 10**5):
        for k in (1, 20, 500):
            got, want = _block(v, 30, k, rng.permutation(len(v)))
            assert got == want
