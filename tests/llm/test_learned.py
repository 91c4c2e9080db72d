"""Language identification and quality scores: held-out accuracy, gradients, odd rows."""

from __future__ import annotations

import binascii

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import langid, quality
from adlake.llm.common import first_by_hash, table

SF = "/root/testdata/sf0.01"


def _held_out(doc_id) -> bool:
    return binascii.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def short_training():
    patch = pytest.MonkeyPatch()
    patch.setattr(langid, "STEPS", 60)
    yield
    patch.undo()


def test_held_out_languages(spark, short_training):
    docs = table(spark, SF, "documents")
    rows = langid.identify(docs).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    assert all(r["held_out"] == _held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.95


def test_odd_texts(spark, short_training):
    docs = [(i, t, lang, "x") for i in range(30) for t, lang in (("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de"))]
    odd = [(100, None, "en", "x"), (101, "", None, "x"), (102, "123 !?", "de", "x"), (103, "the dog " * 5000, None, "x"), (None, "und die " * 9, None, "x"), (104, "é" * 70, None, "x")]
    df = spark.createDataFrame([*docs, *odd, odd[0]], "doc_id long, text string, lang string, score string")
    rows = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(df).collect()]
    by_id = {d: (p, s) for d, p, s in rows}
    assert len(rows) == 67
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert by_id[103][0] == "en" and by_id[None][0] == "de" and by_id[104][0] in ("en", "de")
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns
    assert {100, 101, 102}.isdisjoint({r["doc_id"] for r in kept.collect()}) and kept.count() >= 62
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = langid.identify(df.filter("doc_id = 103"))
    assert [(r["lang_pred"], r["score"]) for r in unlabelled.collect()] == [("und", 0.0)]


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    h = langid.HIDDEN
    table_ = rng.normal(0, 0.3, (3 * h, 257)).astype(np.float32)
    table_[: 2 * h] += 0.5
    weights = rng.normal(0, 0.2, (3 * h, h)).astype(np.float32)
    columns = rng.integers(0, 257, (5, 3)).astype(np.intp)
    target = rng.normal(0, 1, (5, h, 3)).astype(np.float32)

    def loss(t, w):
        return float((langid._forward(t, w, columns)[0].astype(float) * target).sum())

    _, kept = langid._forward(table_, weights, columns, keep=True)
    d_table, d_weights = langid._backward(weights, columns, kept, target)
    for grad, value, which in ((d_table, table_, 0), (d_weights, weights, 1)):
        good = 0
        picks = [(rng.integers(value.shape[0]), columns[rng.integers(5), 0] if which == 0 else rng.integers(h)) for _ in range(20)]
        for i, j in picks:
            up, down = value.copy(), value.copy()
            up[i, j] += 1e-2
            down[i, j] -= 1e-2
            args = lambda v: (v, weights) if which == 0 else (table_, v)  # noqa: E731, B023
            slope = (loss(*args(up)) - loss(*args(down))) / 2e-2
            good += abs(slope - grad[i, j]) < 0.05 * max(1, abs(slope))
        assert good >= 17  # clipping has corners


def test_spans_cover_the_text():
    data = bytes(range(97, 123)) * 9
    rows = langid.spans_of(data)
    assert bytes(rows[rows != langid.PAD].astype(np.uint8)) == data
    assert langid.spans_of(b"").shape == (0, langid.SPAN)


def test_held_out_quality(spark):
    docs = table(spark, SF, "documents")
    label = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    rows = quality.rate(docs, table(spark, SF, "labels")).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == _held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    again = quality.rate(docs.repartition(3), table(spark, SF, "labels")).collect()
    scores = [{r["doc_id"]: r["score"] for r in run} for run in (rows, again)]
    assert all(abs(scores[1][d] - s) < 1e-6 for d, s in scores[0].items())


def test_quality_of_odd_rows(spark):
    docs = [(i, "a fine text of words " * 20 if i % 2 else "spam spam spam " * 20, 1) for i in range(40)]
    docs += [(50, None, 1), (51, "", 1), (None, "x", 1), (52, "word " * 40000, 1), (52, "word " * 40000, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(1, 0, None), (None, 1, None), (3, None, 1), (4, 7, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r["score"] for r in quality.rate(df, labels).collect()}
    assert len(rows) == 44 and rows[50] == rows[51]
    assert np.mean([rows[i] for i in range(3, 40, 2)]) > np.mean([rows[i] for i in range(0, 40, 2)])
    assert {r["score"] for r in quality.rate(df, labels.limit(0)).collect()} == {0.5}
    assert quality.rate(df.limit(0), labels).count() == 0


def test_repeated_words_show_in_the_features():
    x, counts = quality.features(["one two three four", "one one one one", None, "a b a b a b"])
    assert list(counts) == [1, 1, 1, 1]
    column = quality.BUCKETS + quality._CLASSES
    assert np.allclose(x[:, column + 1], [0, 0.75, 0, 0])
    assert np.allclose(x[:, column + 2], [0, 0.5, 0, 4 / 6])
    split, n = quality.features(["x " * 1000, "  y"])
    assert list(n) == [-(-2000 // quality.PASSAGE), 1] and len(split) == n.sum()


def test_languages_that_are_kept(spark, short_training):
    """The limit follows the number of languages; with one, every text with a letter stays."""
    both = table(spark, SF, "documents").filter("lang in ('en', 'de')").select("doc_id", "text", "lang")
    noise = [(900_000 + i, t, None) for i, t in enumerate(["12 34", "", None, "zq" * 40])]
    docs = both.union(spark.createDataFrame(noise, both.schema))
    kept = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert not kept & {900_000, 900_001, 900_002}
    lettered = {r["doc_id"] for r in both.filter(F.col("text").rlike(r"\p{L}")).collect()}
    assert len(lettered - kept) <= 0.02 * len(lettered)
    none = langid.keep_identified(docs, over_chance=2.01)
    assert none.count() == 0
    one = langid.keep_identified(docs.filter("lang = 'en' or lang is null"))
    assert 900_003 in {r["doc_id"] for r in one.collect()}


def test_samples_are_cut_before_they_are_ranked(spark):
    df = spark.range(50_000).select(F.when(F.col("id") < 30, "few").otherwise("many").alias("k"), "id")
    hashed = F.xxhash64("id")
    left = first_by_hash(df, "k", hashed, 100)
    counts = {r["k"]: r["count"] for r in left.groupBy("k").count().collect()}
    assert counts["few"] == 30 and 100 <= counts["many"] < 500
    first = [r["id"] for r in df.filter("k = 'many'").orderBy(hashed).limit(100).collect()]
    assert set(first) <= {r["id"] for r in left.collect()}


def test_a_very_long_labelled_text(spark):
    """Training sees a bounded number of its passages, spread over it; scoring sees all."""
    assert list(quality._spread(3, 5)) == [0, 1, 2]
    assert list(quality._spread(1000, 3)) == [0, 499, 999]
    rows = [(i, " ".join(f"w{i * k % 97}" for k in range(40)) + ".") for i in range(1, 30)] + [(50, "long text here. " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    found = quality.rate(docs, labels).collect()
    assert len(found) == 30 and all(0 <= r["score"] <= 1 for r in found)
