"""Mixing, licences and personal data against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adlake.llm import licenses, mixing, pii
from adlake.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing


def _targets(sizes: dict, share=1.5, most=2.0, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    pool, stopped = share * sum(sizes.values()), set()
    while True:
        rest = pool - sum(most * sizes[s] for s in stopped)
        total = sum(weight[s] for s in names if s not in stopped)
        level = rest / total if total else 0
        above = {s for s in names if s not in stopped and level * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in stopped else level * weight[s] for s in names}
        stopped |= above


def _check_mix(rows, docs, block=16):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows)
    want = sorted((d[0] is None, d[0] or 0, len(WORD.findall(d[2] or ""))) for d in docs)
    assert got == want
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(WORD.findall(text or ""))
    targets, taken = _targets(sizes), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(2 * block, 0.01 * target)


def test_mix_reaches_its_targets(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "text")
    rows = mixing.mix(docs, shard_words=4000).collect()
    _check_mix(rows, [tuple(r) for r in docs.collect()])
    again = mixing.mix(docs.repartition(5), shard_words=4000).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(spark):
    docs = [(i, "hot", "a b c " * (i % 40)) for i in range(150)]
    docs += [(7, None, "x y\x0bz"), (7, None, "x y\x0bz"), (None, None, None), (9, "", ""), (10, "é", "w " * 5000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, source string, text string, size long, _key int")
    rows = mixing.mix(df, shard_words=300, shard_docs=20).collect()
    _check_mix(rows, docs)
    assert "_key" in rows[0].asDict()
    empty = mixing.mix(df.limit(0))
    assert empty.count() == 0


def test_rows_without_ids_are_dealt_over_shards(spark):
    """Null and repeated ids: their texts draw the places, so no shard holds them all."""
    texts = [f"word{i} and more" for i in range(6000)]
    rows = [(None if i % 2 else 7, "a", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, shard_docs=100).collect()
    assert len(got) == 6000
    drawn = df.select(F.md5(F.concat_ws("|", F.lit("17"), F.col("doc_id").cast("string"), F.md5("text"))).alias("d"))
    assert drawn.distinct().count() == 6000
    taken = sum(r["taken"] for r in got)
    assert abs(taken - got[0]["target"]) < 0.02 * taken and all(r["taken"] <= 2 * r["size"] for r in got)


def test_quotients_give_the_seats(spark):
    groups = {"g": {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0}, "h": {"x": 1.0, "y": 1.0, "z": 1.0}}
    wanted = {"g": 7, "h": 5}
    rows = [(g, c, w, wanted[g]) for g, cells in groups.items() for c, w in cells.items()]
    df = spark.createDataFrame(rows, "grp string, cell string, share double, wanted long")
    got = {(r["grp"], r["cell"]): r["seats"] for r in mixing.sainte_lague(df).collect()}
    for g, cells in groups.items():
        seats = Counter()
        for _ in range(wanted[g]):
            best = min((c for c in cells if cells[c] > 0), key=lambda c: (-cells[c] / (2 * seats[c] + 1), c))
            seats[best] += 1
        assert {c: got.get((g, c), 0) for c in cells} == {c: seats[c] for c in cells}


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str | None):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (CARD, lambda m: 14 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": (PHONE, lambda m: 10 <= len(digits(m)) <= 15),
    }
    return {k: [m.span() for m in p.finditer(text) if ok(m)] for k, (p, ok) in tests.items()}


def _check_pii(rows, texts):
    for r, text in zip(rows, texts):
        spans = base_spans(text)
        for k, found in spans.items():
            assert r[f"n_{k}"] == len(found), (k, text)
        order = list(spans)
        listed = sorted((s, order.index(k), e, k) for k, f in spans.items() for s, e in f)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in listed)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (joined, r["spans"])
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


ODD = [
    None,
    "",
    "a.b@c.d_e@f.g %@x.y. z@q..r @a.b é@ü.de x@y.z.",
    "1.2.3.4.5.6.7.8 999.1.1.1 0255.0.0.01 1.2.3 1.2.3.4567 00000000000000000000001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 12345678901234567890 79927398713",
    "+1 (415) 555-0100 +12 +1-----2 +123456789012345 +1234567890123456 ++49 30 123456-78",
    "\U0001f600 mail a@b.co \U0001f600\U0001f600 4111111111111111 " * 3,
    "9" * 30000 + " " + "a" * 30000 + " " + "1." * 9000 + "@" + "a." * 5000,
    "account GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765431, ssn 078-05-1120 or 078-05-1120",
]


def test_pii_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(ODD)], "doc_id long, text string, pii int")
    rows = pii.digest(pii.find_pii(df)).orderBy("doc_id").collect()
    _check_pii(rows, ODD)
    assert "iban:8:35" in rows[-1]["spans"] and rows[-1]["spans"].count("iban") == 1
    assert "national:68:79" in rows[-1]["spans"]
    assert pii.digest(pii.find_pii(df.limit(0))).count() == 0


def test_pii_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").orderBy("doc_id")
    rows = pii.digest(pii.find_pii(docs)).orderBy("doc_id").collect()
    _check_pii(rows, [r["text"] for r in docs.collect()])


def test_redaction(spark):
    texts = ["mail a.b@c.de or call +1 (415) 555-0100.", None, "clean", "\U0001f600 1.2.3.4"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    rows = pii.redact(df).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["mail [EMAIL] or call [PHONE].", None, "clean", "\U0001f600 [IP]"]
    assert rows[0]["pii"] == "k"


# --- licences


def _plain(sentence: str) -> str:
    kept = re.sub(r"[^a-z0-9.]+|\.(?![0-9])", " ", sentence.lower())
    return " ".join(kept.split())


def _scan(text: str | None):
    known = {_plain(v): k for k, v in licenses.SENTENCES.items()}
    pieces = re.split(licenses.BREAK, text or "")
    ids = [known[_plain(p)] for p in pieces if _plain(p) in known]

    def follows(rule):
        rest = iter(ids)
        return all(s in rest for s in rule)

    hits = [(name, kind) for name, kind, rule in licenses.RULES if follows(rule)]
    return len(ids), ",".join(ids), ",".join(sorted({n for n, _ in hits})), hits[0][1] if hits else "none"


def test_licenses(spark):
    mit = " ".join(v + "." for k, v in licenses.SENTENCES.items() if k in ("mit-grant", "mit-condition", "as-is"))
    texts = [None, "", mit, "RELEASED under the MIT license!\nAll rights reserved.", "x Released under the MIT License.", "The above copyright notice. " * 9]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    got = [tuple(r)[1:] for r in licenses.scan_licenses(df).orderBy("doc_id").collect()]
    assert got == [_scan(t) for t in texts]
    assert got[2][2] == "MIT" and got[3][2] == "MIT,proprietary"
    docs = table(spark, "/root/testdata/sf0.01", "documents").orderBy("doc_id")
    got = [tuple(r)[1:] for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()]
    assert got == [_scan(r["text"]) for r in docs.collect()]
    assert sum(g[0] for g in got) > 10
