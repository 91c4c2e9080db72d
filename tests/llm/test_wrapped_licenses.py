"""Licence sentences in their usual hard-wrapped and commented form."""

from __future__ import annotations

import textwrap
import time

from adlake.llm import licenses


def test_every_rule_wrapped(spark):
    texts, want = [], []
    for name, _, rule in licenses.RULES:
        for width, mark in ((70, ""), (40, " * "), (60, "# "), (50, "! "), (64, "//  ")):
            paragraphs = [textwrap.wrap(licenses.SENTENCES[s] + ("" if licenses.SENTENCES[s].endswith(":") else "."), width) for s in rule]
            blank = "\r\n" if mark == "# " else "\n"
            texts.append((mark.rstrip() + blank).join(blank.join(mark + line for line in p) + blank for p in paragraphs))
            want.append((len(rule), ",".join(rule), name))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan_licenses(df).orderBy("doc_id").collect()
    for text, w, r in zip(texts, want, rows):
        assert (r["n_sentences"], r["sentence_ids"]) == w[:2], text
        assert w[2] in r["licenses"].split(",")


def test_no_join_over_ends(spark):
    texts = ["Released under\n\nthe MIT License", "Released under the.\nMIT License", "Released under\n *\n the MIT License",
             "Never released\nunder the MIT License", "Note: Released under the\nMIT License"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan_licenses(df).orderBy("doc_id").collect()
    assert [r["n_sentences"] for r in rows] == [0, 0, 0, 0, 1]


def test_very_many_notices(spark):
    """Rules are matched in one pass, however often their first sentences stand in a text."""
    rule = next(ids for name, _, ids in licenses.RULES if name == "BSD-3-Clause")
    text = lambda ids: "\n\n".join(licenses.SENTENCES[i] + "." for i in ids)
    rows = [(1, text(rule[:-1] * 2000)), (2, text(rule[:-1] * 2000 + rule[-1:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    started = time.monotonic()
    got = {r["doc_id"]: r["licenses"].split(",") for r in licenses.scan_licenses(df).collect()}
    assert "BSD-3-Clause" not in got[1] and "BSD-3-Clause" in got[2]
    assert time.monotonic() - started < 60
