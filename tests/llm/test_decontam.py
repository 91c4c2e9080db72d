"""Leaked benchmark items, verbatim and with other values."""

from __future__ import annotations

import re

from adlake.llm import decontam
from adlake.llm.common import table

ITEM = "A train leaves Boston at 9 with 120 people and Alice meets Bob after 45 minutes, so how far did Alice and Bob walk in 45 minutes?"


def _leaks(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.find_leaks(d, b, **how).collect()
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in rows}


def test_values_may_differ_but_must_correspond(spark):
    other = ITEM.replace("Boston", "Paris").replace("120", "77").replace("45", "30").replace("Alice", "Carla")
    mixed = other.replace("30 minutes,", "31 minutes,").replace("Carla and Bob walk in", "Carla and Dan walk in")
    docs = [(1, "before it " + ITEM + " after"), (2, other), (3, "x " + mixed + " y"), (4, "nothing of this kind at all here"), (5, None), (6, ""), (None, ITEM), (1, "before it " + ITEM + " after")]
    got = _leaks(spark, docs, [(9, ITEM), (8, None), (7, "too short"), (6, "1 2 3 4 5 6 7"), (9, ITEM)])
    assert got[(1, 9)] == "verbatim" and got[(None, 9)] == "verbatim"
    assert got[(2, 9)] == "reparameterised"
    assert (3, 9) not in got
    assert {d for d, _ in got} == {1, 2, None}
    assert _leaks(spark, docs, []) == {} and _leaks(spark, [], [(9, ITEM)]) == {}


def test_without_the_filter(spark, monkeypatch):
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", 0)
    assert _leaks(spark, [(1, "a " + ITEM), (2, "b c")], [(9, ITEM)]) == {(1, 9): "verbatim"}


def test_table_against_plain_search(spark):
    """Every item of which the words stand in a text is found, and no clean text is."""
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, sf, "benchmark").collect()}
    rows = decontam.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = {d: plain(t) for d, t in docs.items()}
    held = {(d, i) for i, q in items.items() for d, t in texts.items() if plain(q) in t}
    assert held and held <= got
    for d, i in got - held:
        words = plain(items[i]).split()
        runs = [" ".join(words[k : k + 5]) for k in range(len(words) - 4)]
        assert sum(r in texts[d] for r in runs) >= 0.3 * len(runs)


def test_dropped_documents(spark):
    df = spark.createDataFrame([(1, ITEM, "k"), (1, "other text", "k"), (2, None, "k"), (None, "a " + ITEM, "k")], "doc_id long, text string, text_key string")
    kept = decontam.drop_leaks(df, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in df.collect() if r["text"] in ("other text", None)]))
