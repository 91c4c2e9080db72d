"""Every stage of the corpus pipeline against a plain version, on what the stage before kept."""

from __future__ import annotations

import re

import pytest
from test_native import _check_mix, base_spans
from test_similar_sets import kept_ids

import corpus_pipeline
from adlake.llm import langid
from adlake.llm.common import stored, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after each stage, with a few that must go."""
    docs = table(spark, SF, "documents")
    first = docs.orderBy("doc_id").first()
    near = " ".join(first["text"].split()[:-1])
    item = table(spark, SF, "benchmark").filter("text is not null").orderBy("item_id").first()["text"]
    added = [
        (9001, None, "en", "src1", 0),
        (9002, "12 34 !!", None, None, 8),
        (9003, first["text"], first["lang"], first["source"], 1),
        (9004, near, first["lang"], first["source"], 1),
        (9005, "words before it " + item + " and after", "en", "src2", 1),
        (9006, "write to some.one@mail.example.org or call +1 (415) 555-0100 about the thing", "en", None, 1),
    ]
    docs = docs.union(spark.createDataFrame(added, docs.schema))
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def _ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_return_documents(steps, spark):
    names = table(spark, SF, "documents").columns
    for rows in steps[:-1]:
        assert rows[0].__fields__ == names
    assert steps[-1][0].__fields__[: len(names)] == names


def test_language(steps):
    before, after = steps[0], steps[1]
    gone = set(_ids(before)) - set(_ids(after))
    lettered = {r["doc_id"] for r in before if r["text"] and langid._LETTER.search(r["text"])}
    assert {9001, 9002} <= gone
    assert len(gone & lettered) <= 1 and gone >= set(_ids(before)) - lettered


def test_near_duplicates(steps):
    before, after = steps[1], steps[2]
    assert _ids(after) == kept_ids([(r["doc_id"], r["text"]) for r in before])
    assert {9003, 9004}.isdisjoint(_ids(after))


def test_decontamination(steps, spark):
    before, after = steps[2], steps[3]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r["text"]) for r in table(spark, SF, "benchmark").collect() if r["text"]]
    held = {r["doc_id"] for r in before if any(q in plain(r["text"]) for q in items)}
    gone = set(_ids(before)) - set(_ids(after))
    assert 9005 in held and held <= gone
    assert len(gone - held) <= 0.02 * len(before)


def test_personal_data(steps):
    before = {r["doc_id"]: r["text"] for r in steps[3]}
    assert _ids(steps[4]) == sorted(before)
    for r in steps[4]:
        spans = sorted(s for found in base_spans(before[r["doc_id"]]).values() for s in found)
        text = before[r["doc_id"]]
        if not spans:
            assert r["text"] == text
            continue
        for low, high in spans:
            assert text[low:high] not in r["text"]
        # What lies before the first and after the last is kept.
        assert r["text"].startswith(text[: spans[0][0]])
        assert r["text"].endswith(text[max(h for _, h in spans) :])


def test_mixing(steps):
    before, after = steps[4], steps[5]
    taken = {r["doc_id"]: r for r in after}
    rows = [
        {
            "doc_id": r["doc_id"],
            "source": r["source"],
            "size": len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])),
            "source_size": None,
            "target": None,
            "taken": taken[r["doc_id"]]["taken"] if r["doc_id"] in taken else 0,
        }
        for r in before
    ]
    by_source = {r["source"]: r for r in after}
    for row in rows:
        row["source_size"] = by_source[row["source"]]["source_size"]
        row["target"] = by_source[row["source"]]["target"]
    _check_mix(rows, [(r["doc_id"], r["source"], r["text"]) for r in before])
    assert all(r["taken"] > 0 for r in after)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 40 < len(rows) < 200
    assert corpus_pipeline.ORACLE_SQL is None
