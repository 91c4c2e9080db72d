"""Repair of conversations against a plain search over words of edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from check_oracle import actual, connect, expected

from adlake.llm import conversations, oracles, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        was = (role, hashlib.md5(text.encode()).hexdigest())
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        for copy in range(2 if fault == 3 else 1):
            out.append((conv, turn, role, text, was, copy))
    return out


def _best(rows):
    """(cost, audit, lines) by best-first search; rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, word, at, state, lines = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and state in (0, 3):
            return cost, word, "\n".join(lines)
        turn, name = ("a", "assistant") if state == 2 else ("u", "user")
        heapq.heappush(heap, (cost + 2, word + "I", at, NEXT[state][turn], (*lines, f"{name}:")))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 3, word + "D", at + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        extra = fault == "truncated"
        if role[:1] in NEXT[state]:
            heapq.heappush(heap, (cost + extra, word + "K", at + 1, NEXT[state][role[:1]], (*lines, f"{role}:{text}")))
        heapq.heappush(heap, (cost + 2 + extra, word + "R", at + 1, NEXT[state][turn], (*lines, f"{name}:{text}")))


def _expected(given, damaged):
    out = []
    order = lambda r: (r[1] is not None, r[1] or 0, r[4], r[5])
    for conv in {r[0] for r in given}:
        rows = sorted((r for r in damaged if r[0] == conv), key=order)
        seen, faulty = set(), []
        for _, _, role, text, _, _ in rows:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            fault = None
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif bare[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == n for _, _, f in faulty) for n in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        cost, word, text = _best(faulty)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, word, digest))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def _random_rows(rng, ids, longest):
    rows = []
    for conv in ids:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["", " ", "a b.", "c!", "d", "e?\n", "f ...", None, f"g{turn}", f"h{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn // 2, None]), role, text))
    return rows


def _found(spark, rows, damage=True):
    df = spark.createDataFrame(rows, SCHEMA)
    damaged = conversations.damage(df) if damage else conversations.as_given(df)
    got = conversations.repair(df, damaged)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("cell", [4096, 3, 1])
def test_random_conversations(spark, monkeypatch, cell):
    """Ties, nulls, repeated rows and unknown roles; also in cells of few rows."""
    monkeypatch.setattr(conversations, "CELL", cell)
    rows = _random_rows(random.Random(cell), [None, *range(60)], 9)
    assert _found(spark, rows) == _expected(rows, _damaged(rows))


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CELL", 50)
    rng = random.Random(1)
    rows = _random_rows(rng, [5], 3)[:1] + [
        (5, t, rng.choice(["user", "assistant", "system"]), rng.choice(["x", "y."]) + str(t % 400) + rng.choice([".", ""]))
        for t in range(1500)
    ]
    assert _found(spark, rows) == _expected(rows, _damaged(rows))


def test_table_as_it_is_and_rows(spark):
    """Without damage, and the rows themselves."""
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "user", "u."), (2, 0, "user", "u."), (2, 1, "tool", "t")]
    df = spark.createDataFrame([(*r, 9) for r in rows], SCHEMA + ", kind int")
    found = conversations.repair(df, conversations.as_given(df)).collect()
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found} == {1: (4, "KIKKI"), 2: (3, "KR")}
    left = conversations.repaired_rows(conversations.as_given(df)).orderBy("conv_id", "place").collect()
    assert [(r["conv_id"], r["edit"], r["role"], r["text"]) for r in left] == [
        (1, "K", "system", "s."), (1, "I", "user", ""), (1, "K", "assistant", "a."), (1, "K", "user", "u."),
        (1, "I", "assistant", ""), (2, "K", "user", "u."), (2, "R", "assistant", "t"),
    ]


def test_prices_are_distances():
    """Converged prices are exact, so every tight arc leads on to the end."""
    rng = random.Random(2)
    for _ in range(200):
        codes = [(rng.choice("suax"), rng.randint(0, 3)) for _ in range(rng.randint(0, 7))]
        auction = conversations._Auction(codes, None)
        faults = [None, "blank", "duplicate", "truncated"]
        cost, word, _ = _best([(i, "t", faults[f]) for i, f in codes])
        assert auction.price[0][0] == cost and auction.trace(0)[:2] == (word, cost)


def test_empty_and_all_dropped(spark):
    assert _found(spark, []) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert _found(spark, [(gone, 0, "user", "x.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_query_equals_sql(spark):
    want = expected(connect(SF), oracles.oracle_sql()["op11_conversations"])
    assert actual(queries.op11_conversations(spark, SF)) == want
