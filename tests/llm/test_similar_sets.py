"""The near-duplicate stage against the exact similarity of the shingle sets."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from adlake.llm import simhash
from adlake.llm.common import table


def kept_ids(docs: list[tuple]) -> list:
    """Ids of (doc_id, text) left if pairs at 0.8 or more, compared exactly, are connected."""
    sets = {d: frozenset(simhash.shingles(t, 5, True)) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        low, high = sorted((len(sets[a]), len(sets[b])))
        if low * 5 < high * 4:
            continue
        common = len(sets[a] & sets[b])
        if common * 9 >= 4 * (low + high):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted(d for d in sets if find(d) == d)


def _pairs(similarity: float, n: int, size: int = 200) -> list[tuple]:
    """n pairs of texts of fresh words; the ends of the second differ, down to ``similarity``."""
    rng = random.Random(7)
    docs = []
    own = round(size * (1 - similarity) / (1 + similarity))
    for i in range(n):
        text = [f"w{rng.getrandbits(60)}" for _ in range(size + 4)]
        docs.append((2 * i, " ".join(text)))
        docs.append((2 * i + 1, " ".join(text[: size + 4 - own] + [f"v{rng.getrandbits(60)}" for _ in range(own)])))
    return docs


def _left(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.drop_near_duplicates(df).collect())


def test_pairs_below_stay(spark):
    docs = _pairs(0.7, 150)
    assert kept_ids(docs) == sorted(d for d, _ in docs)
    assert _left(spark, docs) == kept_ids(docs)


def test_short_texts_stay(spark):
    """Texts of two shingles that share none."""
    rng = random.Random(3)
    docs = [(i, " ".join(f"w{rng.getrandbits(40)}" for _ in range(6))) for i in range(4000)]
    assert _left(spark, docs) == list(range(4000))


def test_groups_in_parts(spark, monkeypatch):
    """Parts of a group meet each other."""
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(5)
    base = [f"w{rng.getrandbits(60)}" for _ in range(120)]
    docs = []
    for i in range(100):
        text = base[:]
        text[rng.randrange(10, 110)] = f"v{i}"
        docs.append((i, " ".join(text)))
    assert _left(spark, docs) == kept_ids(docs) == [0]


@pytest.mark.parametrize("step", [8, 16, 5])
def test_chains_in_parts(spark, monkeypatch, step):
    """Texts that share words with their neighbours alone: no pivot reaches all of a group."""
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(step)
    words = [f"w{rng.getrandbits(60)}" for _ in range(60 * step + 120)]
    docs = [(i, " ".join(words[i * step : i * step + 120])) for i in range(60)]
    assert _left(spark, docs) == kept_ids(docs)


def test_ids_shared_by_different_texts(spark):
    """Only the copy goes, not the other text of its id; null ids go last, equal rows once."""
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.getrandbits(60)}" for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(1, a, "x"), (5, a + " more", "x"), (5, b, "x"), (None, a, "y"), (None, c, "y"), (None, c + " more", "y"), (7, b, "z"), (7, b, "z"), (8, None, "z"), (None, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    left = [tuple(r) for r in simhash.drop_near_duplicates(df).collect()]
    kept = {(i, t) for i, t, _ in left}
    assert len(left) == 4 and {(1, a), (5, b), (8, None)} < kept
    assert len(kept & {(None, c), (None, c + " more")}) == 1


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_pairs_at_the_limit_go(spark, similarity):
    docs = [*_pairs(similarity, 300, 180), *_pairs(0.7, 20, 90)[1::2]]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    kept = kept_ids(docs)
    assert len(kept) == 320
    assert _left(spark, docs) == kept


def test_table_of_near_copies(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    docs = [(r["doc_id"], r["text"]) for r in rows][:2500]
    kept = kept_ids(docs)
    assert len(kept) < len(docs)
    assert _left(spark, docs) == kept


def test_candidates_share_a_deletion_variant(spark):
    """Sets are candidates by segments of their SimHash that differ by at most one bit."""
    docs = [(100 * i + d, t) for i, s in enumerate((0.55, 0.7, 0.8)) for d, t in _pairs(s, 12, 60)]
    short = [f"s{i}" for i in range(9)]
    docs += [(900, " ".join(short)), (901, " ".join(short[:-1])), (902, " ".join(["x", *short[1:]]))]
    masks = simhash.set_segments(len(docs))
    assert masks == simhash.set_segments(1) and all(m.bit_count() == simhash.SEGMENT for m in masks)
    lanes = masks[-1].bit_length() // 64 + 1
    schema = "doc_id long, node long, size long, subsets array<long>, " + ", ".join(f"_fp{i} long" for i in range(lanes))
    df = spark.createDataFrame(docs, "doc_id long, text string").select("text", "doc_id")
    prints = simhash.stored(simhash.map_arrow(df, simhash._set_prints(5, lanes), schema))
    rows = prints.collect()
    bits = {r["node"]: sum((r[f"_fp{i}"] & (2**64 - 1)) << (64 * i) for i in range(lanes)) for r in rows}
    size = {r["node"]: r["size"] for r in rows}
    subsets = {r["node"]: set(r["subsets"]) for r in rows}
    first = (1 << 64 * simhash.CARRIED) - 1
    root = {n: n for n in bits}
    for a, b in combinations(bits, 2):
        x = bits[a] ^ bits[b]
        near = any((x & m).bit_count() <= 1 for m in masks) and (x & first).bit_count() <= simhash.APART
        if subsets[a] & subsets[b] or (near and min(size[a], size[b]) > simhash.ALONE):
            low, high = sorted((root[a], root[b]))
            root = {n: low if r == high else r for n, r in root.items()}
    got = {r["node"]: r["component"] for r in simhash.components(simhash.set_candidates(prints, masks, lanes)).collect()}
    assert got == {n: r for n, r in root.items() if r != n}
    assert len(got) > 15


def _near_prints(n: int, seed: int, flips: int) -> list[int]:
    """n fingerprints of 13 lanes, each some random flips from one centre."""
    rng = random.Random(seed)
    centre = rng.getrandbits(64 * 13)
    return [centre ^ sum(1 << b for b in rng.sample(range(64 * 13), flips)) for _ in range(n)]


def test_links_of_a_large_group_do_not_add_up_over_the_passes(spark):
    masks = simhash.set_segments(1)
    rows = [(i + 1, *[(f >> 64 * k & 2**64 - 1) - (1 << 63) for k in range(13)]) for i, f in enumerate(_near_prints(600, 1, 60))]
    df = spark.createDataFrame(rows, "node long, " + ", ".join(f"_fp{k} long" for k in range(13)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = simhash.stored(simhash.links(df, simhash.APART, masks, 13, simhash.CARRIED))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    connected = {r["node"]: r["component"] for r in simhash.components(found).collect()}
    assert connected == {i: 1 for i in range(2, 601)}
    # One mask of 16 bits gives a node 16 links at most, and the others few.
    assert found.filter("a <> b").distinct().count() <= 20 * 600


def test_sets_that_share_nothing_are_no_candidates(spark):
    """Chance candidates grow with the table and would connect all its groups to one."""
    rng = random.Random(9)
    masks = simhash.set_segments(1)[:12]
    rows = [(i, *[rng.getrandbits(64) - (1 << 63) for _ in range(13)]) for i in range(20000)]
    df = spark.createDataFrame(rows, "node long, " + ", ".join(f"_fp{k} long" for k in range(13)))
    found = simhash.links(df, simhash.APART, masks, 13, simhash.CARRIED)
    assert found.filter("a <> b").distinct().count() == 0


@pytest.mark.parametrize("rows", [1, 3, 7, 1000])
def test_large_variants_pass_on_numbered_members(monkeypatch, rows):
    """Members of variants above the bucket, over batches of any length."""
    monkeypatch.setattr(simhash, "BUCKET", 4)
    rng = random.Random(4)
    given = [(k, rng.randrange(100, 140), rng.getrandbits(3)) for k, n in ((1, 9), (2, 2), (3, 12), (4, 4), (5, 6)) for _ in range(n)]
    given += [(6, 50, 0)] * 8 + [(7, 60, 7), (7, 61, 7)]
    columns = [np.array(c, np.int64) for c in zip(*given)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c[at : at + rows]) for c in columns], ["key", "node", "_fp0"])
        for at in range(0, len(given), rows)
    ]
    out = [r for b in simhash._bucket_links(1, 1)(iter(batches)) for r in b.to_pylist()]
    large = [r for r in out if r["kind"] == simhash.LARGE]
    for key in {r["key"] for r in large}:
        some = [r for r in large if r["key"] == key]
        assert [r["b"] for r in some] == [n for k, n, _ in given if k == key]
        assert len({r["a"] for r in some}) == len(some)
    # Without the variants that were passed on, links are whole; with them, none is made up.
    near = lambda done: {
        frozenset((a, b)) for (j, a, x), (k, b, y) in combinations(given, 2) if j == k and j in done and a != b and (x ^ y).bit_count() <= 1
    }

    def classes(pairs):
        root = {n: n for _, n, _ in given}
        for a, b in map(sorted, pairs):
            low, high = sorted((root[a], root[b]))
            root = {n: low if r == high else r for n, r in root.items()}
        return root

    keys = set(columns[0].tolist())
    alike = {k for k in keys if len({n for j, n, _ in given if j == k}) == 1}
    passed = {r["key"] for r in large}
    assert passed - alike == {1, 3, 5}
    links = {frozenset((r["a"], r["b"])) for r in out if r["kind"] == simhash.LINK and r["a"] != r["b"]}
    assert classes(near(keys - passed) | links) == classes(links)
    assert classes(near(keys) | links) == classes(near(keys))
