"""Main text of pages: reading, the field's sums and search, and what it finds."""

from __future__ import annotations

import html
import re
from itertools import product

import numpy as np
import pytest
from check_oracle import actual, connect, expected

from adlake.llm import blocks, oracles, queries
from adlake.llm.common import table

SF = "/root/testdata/sf0.01"


def _texts(page):
    return [t for t, _ in blocks.read_blocks(page)]


@pytest.mark.parametrize(
    "page, texts",
    [
        (None, []),
        ("", []),
        ("<p> </p>", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b>c &amp; d&nbsp;&lt;x&gt;</p>", ["abc & d <x>"]),
        ("<p>one<br>two", ["one", "two"]),
        ("<p><b>one<br><p>two</p>three", ["one", "two", "three"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]),
        ("<script>var t='</p>';</script><style>p{}</style>x<!-- no -->y", ["xy"]),
        ("<head><title>t</title><p>x</p>", ["x"]),
        ("</div></p>a</b><div>b<div>c</section>d", ["a", "b", "cd"]),
        ("<p>cut <a href='", ["cut"]),
    ],
)
def test_reading(page, texts):
    got = _texts(page)
    assert " ".join(got) == " ".join(texts) or got == texts


def test_long_and_deep_pages():
    deep = "<div>" * 50_000 + "x" + "</span>" * 50_000
    assert _texts(deep) == ["x"]
    assert len(_texts("<p>word " * 100_000)) == 100_000


def _chains(n):
    return product((0, 1), repeat=n)


def _value(scores, step, first, chain):
    return first[chain[0]] + sum(s[c] for s, c in zip(scores, chain)) + sum(step[a][b] for a, b in zip(chain, chain[1:]))


def test_likelihood_against_all_chains():
    """Value and gradient from all chains of padded pages, one by one."""
    rng = np.random.default_rng(0)
    sizes = [1, 4, 6]
    scores, step, first = rng.normal(size=(3, 6, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    labels = rng.integers(0, 2, (3, 6))
    mask = np.arange(6)[None] < np.array(sizes)[:, None]
    plain = lambda s, t, f: sum(
        _value(s[p], t, f, labels[p, :n]) - np.log(sum(np.exp(_value(s[p], t, f, c)) for c in _chains(n)))
        for p, n in enumerate(sizes)
    )
    value, *gradients = blocks.likelihood(scores, labels, mask, step, first)
    assert value == pytest.approx(plain(scores, step, first))
    for which, given in enumerate((scores, step, first)):
        for at in np.ndindex(given.shape):
            moved = [scores.copy(), step.copy(), first.copy()]
            moved[which][at] += 1e-6
            assert (plain(*moved) - value) / 1e-6 == pytest.approx(gradients[which][at], abs=1e-4)


def test_viterbi_against_all_chains():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7):
        field = blocks.Field({str(i): i for i in range(n)}, rng.normal(size=(n, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        best = max(_chains(n), key=lambda c: _value(field.emit, field.step, field.first, c))
        assert tuple(field.decode([[str(i)] for i in range(n)])) == best
    assert len(field.decode([])) == 0


def test_held_out_pages():
    """Layouts of another seed than those it learned from."""
    field, right, blocks_seen = blocks.default_field(), 0, 0
    for page in blocks.training_pages(200, seed=7):
        read = blocks.read_blocks(page)
        labels = field.decode(blocks.features(read))
        right += sum(int(a) == int(b.main) for a, (_, b) in zip(labels, read))
        blocks_seen += len(read)
    assert right / blocks_seen > 0.995


def test_usual_page():
    page = """<body><header><a href=/>Home</a></header><div id="cookie-notice"><p>We use cookies.</p></div>
    <main><article><h1>Title</h1><p>First paragraph with a <a href=/x>link</a>, and more of it.</p>
    <div class="advert">Buy this now and save.</div><p>Second one &mdash; the end.</p>
    <form><label>Mail</label><input></form></article>
    <section class="comments"><p>Nice article, thank you for it.</p></section></main>
    <aside><h3>Related</h3><a href=/y>Other story</a></aside><footer>&copy; 2024 Somebody</footer></body>"""
    text = blocks.main_text(page, blocks.default_field())
    assert text == "Title First paragraph with a link, and more of it. Second one — the end."


def test_rows(spark):
    """Nulls, repeated rows and further columns; empty tables."""
    rows = [(1, "u", "<article><p>a b</p></article>", 5), (1, "u", "<article><p>a b</p></article>", 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, blocks.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "a b", 3)] * 2 + [(None, None, "", 0)], key=str)
    assert blocks.extract(df.limit(0)).collect() == []


def test_all_pages(spark):
    """Every page's article as its markup gives it."""
    want = {}
    for r in table(spark, SF, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        want[r["page_id"]] = " ".join(html.unescape(inner).split())
    assert {r["page_id"]: r["text"] for r in blocks.extract(table(spark, SF, "pages")).collect()} == want


def test_query_equals_sql(spark):
    want = expected(connect(SF), oracles.oracle_sql()["op12_main_text"])
    assert actual(queries.op12_main_text(spark, SF)) == want
