"""Repair of conversation structure by auctions on a lattice of edits.

The rows of a conversation, in order, and the four states of the grammar ``(s?(ua)+)?`` of
role initials make a lattice: node (row, state), and arcs that keep, rerole or delete the
row or insert a row before it, each at a whole cost. An auction finds the cheapest edits:
a path from the origin is extended along the arc that attains its end's price, or
contracted while that end's price is raised. The origins are taken from the last row to
the first, each starting from the prices that are there, so that every auction ends as
soon as it meets a node that was already priced. The converged prices are the costs that
are left to the end; arcs on which they differ by just the cost of the arc are tight, and
the least word of edits follows the tight arc of the least letter from node to node.

Long conversations are cut into cells of at most ``CELL`` rows. The auctions of a cell
give its costs between border states; these small tables, put together per conversation,
price the border of every cell, and each cell is then solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow, stored

# Rows of one conversation that one auction covers.
CELL = 4096

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
# States: nothing yet, after the system row, after a user row, after an assistant row.
STATES = 4
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_TURN = tuple("a" if s == 2 else "u" for s in range(STATES))
_ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT = 2, 3, 2
_FAR = 1 << 60


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) after the faults that the hash of each row names.

    Null roles and texts are one space, and so are null ids and turns inside the hash.
    ``copy`` tells a repeated row (1) from its original (0); ``was`` holds what orders rows
    of the same turn: the role and a digest of the text as they were.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fault = F.crc32(named) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.struct("role", F.md5("text").alias("digest")).alias("was"),
        F.explode(copies).alias("copy"),
    )


def as_given(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form that ``damage`` gives."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    was = F.struct(role.alias("role"), F.md5(text).alias("digest"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), was.alias("was"), F.lit(0).alias("copy")
    )


def _follow(code: tuple[str, int], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after it) of what may be done with a row, by letter."""
    initial, fault = code
    arcs = [("D", DELETE, state)]
    if fault in (SOUND, TRUNCATED):
        extra = 1 if fault == TRUNCATED else 0
        kept = _NEXT[state].get(initial)
        if kept is not None:
            arcs.append(("K", extra, kept))
        arcs.append(("R", REROLE + extra, _NEXT[state][_TURN[state]]))
    return arcs


class _Auction:
    """Prices of the nodes of a cell: the cheapest cost from each to the end.

    ``border`` prices the states after the last row; None stands for the end of the
    conversation, where states that do not end the grammar insert what is missing.
    States of infinite border price take no part.
    """

    def __init__(self, codes: list[tuple[str, int]], border: list[int] | None) -> None:
        self.codes = codes
        self.open_end = border is None
        self.price = [[0] * STATES for _ in range(len(codes) + 1)]
        self.settled = [[False] * STATES for _ in range(len(codes) + 1)]
        last = len(codes)
        if border is not None:
            self.price[last], self.settled[last] = list(border), [True] * STATES
        for row in range(last, -1, -1):
            if row < last:
                # No arc costs less than nothing, so this is a sound price to start from.
                self.price[row] = [min(self.price[row + 1])] * STATES
            for state in range(STATES - 1, -1, -1):
                if not self.settled[row][state]:
                    self._run(row, state)

    def arcs(self, row: int, state: int) -> list[tuple[str, int, int, int]]:
        """(letter, cost, row, state) that leave a node; a row of -1 is the end."""
        out = []
        if row < len(self.codes):
            out = [(letter, cost, row + 1, to) for letter, cost, to in _follow(self.codes[row], state)]
        elif not self.open_end:
            return out
        elif state in _ENDS:
            out.append(("", 0, -1, 0))
        out.append(("I", INSERT, row, _NEXT[state][_TURN[state]]))
        return out

    def _left(self, row: int, state: int) -> int:
        return 0 if row < 0 else self.price[row][state]

    def _run(self, row: int, state: int) -> None:
        path = [(row, state)]
        while True:
            at = path[-1]
            best, to = _FAR, None
            for _, cost, r, s in self.arcs(*at):
                price = cost + self._left(r, s)
                if price < best:
                    best, to = price, (r, s)
            if self.price[at[0]][at[1]] < best:
                # Contraction: the price rises to what the best arc asks.
                self.price[at[0]][at[1]] = best
                if len(path) > 1:
                    path.pop()
                elif to is None:
                    break
                continue
            if to is None or to[0] < 0 or self.settled[to[0]][to[1]]:
                break
            path.append(to)
        for r, s in path:
            self.settled[r][s] = True

    def trace(self, state: int) -> tuple[str, int, int]:
        """(edits, cost, state after them): the least cheapest word from a state before the first row."""
        row, word, spent = 0, [], 0
        while self.open_end or row < len(self.codes):
            left = self.price[row][state]
            tight = [a for a in self.arcs(row, state) if a[1] + self._left(a[2], a[3]) == left]
            letter, cost, row, to = min(tight)
            word.append(letter)
            spent += cost
            if row < 0:
                break
            state = to
        return "".join(word), spent, state


# States from which a border state can be reached at all: no edit makes a system row.
_REACH = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))


def _between(codes: list[tuple[str, int]]) -> list[int]:
    """Cheapest costs from each state before the cell to each one after it, row by row."""
    out = [[_FAR] * STATES for _ in range(STATES)]
    for end, starts in enumerate(_REACH):
        for state, cost in zip(starts, _costs_to(codes, end)):
            out[state][end] = cost
    return [c for row in out for c in row]


def _costs_to(codes: list[tuple[str, int]], end: int) -> list[int]:
    auction = _Bounded(codes, end)
    return [auction.price[0][s] for s in _REACH[end]]


class _Bounded(_Auction):
    """An auction towards one border state, over the states that can reach it."""

    def __init__(self, codes: list[tuple[str, int]], end: int) -> None:
        self.end = end
        super().__init__(codes, [0 if s == end else _FAR for s in range(STATES)])

    def arcs(self, row: int, state: int) -> list[tuple[str, int, int, int]]:
        if state not in _REACH[self.end]:
            return []
        return [
            a
            for a in super().arcs(row, state)
            if a[3] in _REACH[self.end] and (a[2] < len(self.codes) or a[3] == self.end)
        ]


def _codes(cell: list[dict]) -> list[tuple[str, int]]:
    return [(c["initial"], c["fault"]) for c in cell]


def _border_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, part, cell, codes) to (conv_id, part, cell, between)."""
    for batch in batches:
        found = [_between(_codes(c)) for c in batch.column("codes").to_pylist()]
        columns = [batch.column(c) for c in ("conv_id", "part", "cell")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.list_(pa.int64()))], ["conv_id", "part", "cell", "between"]
        )


def _price_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, cells of (part, cell, between)) to (conv_id, part, cell, border) of all but the last."""
    for batch in batches:
        for row in batch.to_pylist():
            cells = sorted(row["cells"], key=lambda c: (c["part"], c["cell"]))
            border = [_Auction([], None).price[0][s] for s in range(STATES)]
            out = []
            for cell, before in zip(reversed(cells), reversed(cells[:-1])):
                costs = cell["between"]
                border = [
                    min(costs[s * STATES + e] + border[e] for e in range(STATES)) for s in range(STATES)
                ]
                out.append((before["part"], before["cell"], border))
            if out:
                ids = pa.array([row["conv_id"]] * len(out), batch.column("conv_id").type)
                part, cell, borders = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(part, pa.int64()), pa.array(cell, pa.int64()), pa.array(borders, pa.list_(pa.int64()))],
                    ["conv_id", "part", "cell", "border"],
                )


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, part, cell, codes, border) with what each state before the cell leads to."""
    for batch in batches:
        words, costs, ends, illegal = [], [], [], []
        for cell, border in zip(batch.column("codes").to_pylist(), batch.column("border").to_pylist()):
            codes = _codes(cell)
            auction = _Auction(codes, border)
            traced = [auction.trace(s) for s in range(STATES)]
            words.append([t[0] for t in traced])
            costs.append([t[1] for t in traced])
            ends.append([t[2] for t in traced])
            pairs = zip(codes, codes[1:])
            illegal.append(sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs))
        columns = [batch.column(c) for c in ("conv_id", "part", "cell")]
        columns += [pa.array(words, pa.list_(pa.string())), pa.array(costs, pa.list_(pa.int64()))]
        columns += [pa.array(ends, pa.list_(pa.int64())), pa.array(illegal, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            columns, ["conv_id", "part", "cell", "words", "costs", "ends", "illegal"]
        )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds (part, place): the number of the sorted partition and of the row in it."""
    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        added = [pa.array([part] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())]
        place += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "part", "place"])


_ORDER = ("conv_id", "turn", "was", "copy")
_BLANKS = r"\x20\x09-\x0D"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _joined(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """A join on keys that may be null; the right side's keys are left out."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(named, on, how).drop(*[f"_{k}" for k in keys])


_CONVERSATION, _CELL = ("conv_id",), ("conv_id", "part", "cell")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, part, place, initial, fault): each row's first fault, without the texts.

    ``rows`` are as ``damage`` gives them. (part, place) order the rows of a conversation by
    turn, nulls first, then by the role and the digest of the text, copies last. A row is
    blank if it holds nothing but white space, a duplicate if an earlier one has its role
    and text, truncated if it does not end on ``.``, ``!`` or ``?``.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    narrow = rows.select(
        *_ORDER,
        "role",
        F.md5("text").alias("digest"),
        (~F.col("text").rlike(f"[^{_BLANKS}]")).alias("blank"),
        F.col("text").rlike(rf"[^.!?{_BLANKS}][{_BLANKS}]*\z").alias("cut"),
    )
    sorted_rows = narrow.repartitionByRange(_partitions(rows), *_ORDER).sortWithinPartitions(*_ORDER)
    schema = (
        f"conv_id {kind}, turn {turn}, was struct<role string, digest string>, copy int, role string, "
        "digest string, blank boolean, cut boolean, part long, place long"
    )
    placed = stored(map_arrow(sorted_rows, _numbered, schema).drop("was", "copy"), "placed")
    same = ("conv_id", "role", "digest")
    at = F.struct("part", "place")
    # Counted before the shuffle, so a row with very many copies is one entry per task.
    first = (
        placed.filter("not blank")
        .groupBy(*same)
        .agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    joined = _joined(placed, first, same, "left")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(at > F.col("first"), DUPLICATE)
        .when(F.col("cut"), TRUNCATED)
        .otherwise(SOUND)
    )
    initial = F.substring("role", 1, 1).alias("initial")
    return joined.select("conv_id", "turn", "part", "place", initial, fault.alias("fault"))


def _cells(flagged: DataFrame) -> DataFrame:
    """(conv_id, part, cell, codes, border): runs of at most ``CELL`` rows of a conversation.

    ``border`` prices the states after the cell, null at the end of a conversation.
    """
    coded = F.sort_array(F.collect_list(F.struct("place", "initial", "fault")))
    cells = stored(
        flagged.groupBy("conv_id", "part", F.floor(F.col("place") / CELL).alias("cell")).agg(coded.alias("codes")),
        "cells",
    )
    several = cells.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    long = _joined(cells, several, _CONVERSATION).drop("n")
    kind = cells.schema["conv_id"].dataType.simpleString()
    between = map_arrow(long, _border_costs, f"conv_id {kind}, part long, cell long, between array<long>")
    # Sixteen numbers for every CELL rows.
    per_conversation = between.groupBy("conv_id").agg(F.collect_list(F.struct("part", "cell", "between")).alias("cells"))
    borders = map_arrow(
        per_conversation, _price_borders, f"conv_id {kind}, part long, cell long, border array<long>"
    )
    return _joined(cells, borders, _CELL, "left")


_PIECE = "words array<string>, costs array<long>, ends array<long>, illegal long, opens string, closes string"


def _rewritten(emit_rows: bool, kind: pa.DataType):
    """Applies the words to the texts, which follow in order, one conversation after the other.

    Gives either the repaired rows or one summary row per conversation, whose digest is
    taken as the rows pass, so that no conversation is held whole.
    """

    def summary(conv, state) -> tuple:
        return conv, state["cost"], state["illegal"], "".join(state["words"]), state["sha"].hexdigest()

    def fresh() -> dict:
        return {
            "words": [], "cost": 0, "illegal": 0, "state": 0, "last": None,
            "sha": hashlib.sha256(), "any": False, "at": 0, "number": 0,
        }

    def piece(state: dict, row: dict) -> None:
        entry = state["state"]
        state["words"].append(row["words"][entry])
        state["cost"] += row["costs"][entry]
        state["illegal"] += row["illegal"]
        if state["last"] is not None:
            state["illegal"] += state["last"] + row["opens"] not in ("su", "ua", "au")
        state["last"], state["state"] = row["closes"], row["ends"][entry]

    def written(state: dict, conv, edit: str, role: str, text: str, out: list) -> None:
        line = f"{role}:{text}"
        state["sha"].update((("\n" if state["any"] else "") + line).encode("utf-8", "surrogatepass"))
        state["any"] = True
        if emit_rows:
            out.append((conv, state["number"], edit, role, text))
            state["number"] += 1

    def inserts(state: dict, conv, word: str, out: list) -> None:
        while state["at"] < len(word) and word[state["at"]] == "I":
            role = _TURN[state["grammar"]]
            state["grammar"] = _NEXT[state["grammar"]][role]
            written(state, conv, "I", ROLES[role], "", out)
            state["at"] += 1

    def apply(state: dict, conv, row: dict, out: list) -> None:
        word = state["word"]
        inserts(state, conv, word, out)
        letter = word[state["at"]]
        state["at"] += 1
        role = row["role"]
        if letter == "D":
            return
        if letter == "R":
            role = ROLES[_TURN[state["grammar"]]]
        state["grammar"] = _NEXT[state["grammar"]][role[:1]]
        written(state, conv, letter, role, row["text"], out)

    names = ["conv_id", "place", "edit", "role", "text"] if emit_rows else ["conv_id", "cost", "illegal", "audit", "repaired_sha256"]
    types = (
        [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        if emit_rows
        else [kind, pa.int64(), pa.int64(), pa.string(), pa.string()]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, started = fresh(), None, False

        def finish(out: list) -> None:
            if not started:
                return
            if "word" in state:
                inserts(state, conv, state["word"], out)
            if not emit_rows:
                out.append(summary(conv, state))

        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if not started or row["conv_id"] != conv:
                    finish(out)
                    state, conv, started = fresh(), row["conv_id"], True
                if row["kind"] == 0:
                    piece(state, row)
                    continue
                if "word" not in state:
                    state["word"], state["grammar"] = "".join(state["words"]), 0
                apply(state, conv, row, out)
            yield batch_of(out)
        out = []
        finish(out)
        yield batch_of(out)

    return run


def _rewrite(rows: DataFrame, flagged: DataFrame, emit_rows: bool) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    cells = _cells(flagged)
    name = kind.simpleString()
    opened = cells.select(
        "conv_id", "part", "cell", "codes", "border",
        F.element_at("codes", 1)["initial"].alias("opens"), F.element_at("codes", -1)["initial"].alias("closes"),
    )
    solved = map_arrow(
        opened.select("conv_id", "part", "cell", "codes", "border"),
        _solve,
        f"conv_id {name}, part long, cell long, words array<string>, costs array<long>, ends array<long>, illegal long",
    )
    solved = stored(solved, "solved")
    ends = opened.select("conv_id", "part", "cell", "opens", "closes")
    pieces = _joined(solved, ends, _CELL)
    fields = [f.strip().split(" ") for f in _PIECE.split(", ")]
    turn = rows.schema["turn"].dataType.simpleString()
    was = "struct<role:string,digest:string>"
    head = pieces.select(
        "conv_id", F.lit(0).alias("kind"), "part", "cell",
        F.lit(None).cast(turn).alias("turn"), F.lit(None).cast(was).alias("was"), F.lit(0).alias("copy"),
        *[F.col(f) for f, _ in fields], F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    body = rows.select(
        "conv_id", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("cell"),
        "turn", "was", "copy", *[F.lit(None).cast(t).alias(f) for f, t in fields], "role", "text",
    )
    dealt = (
        head.union(body)
        .repartition(_partitions(rows), "conv_id")
        .sortWithinPartitions("conv_id", "kind", "part", "cell", "turn", "was", "copy")
        .drop("part", "cell", "turn", "was", "copy")
    )
    schema = (
        f"conv_id {name}, place long, edit string, role string, text string"
        if emit_rows
        else f"conv_id {name}, cost long, illegal long, audit string, repaired_sha256 string"
    )
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(name)
    if arrow is None:
        raise TypeError(f"conv_id must be bigint, int or string, not {name}")
    return map_arrow(dealt, _rewritten(emit_rows, arrow), schema)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the conversations after the cheapest edits.

    ``rows`` are as ``damage`` or ``as_given`` give them; ``place`` counts from 0, ``edit``
    is K, R or I. Conversations of which nothing is left have no rows.
    """
    return _rewrite(rows, faults(rows), True)


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: its faults, the edits and the repaired digest.

    ``rows`` are its rows after damage (or ``as_given``). Null ids are one conversation.
    Null roles and texts are one space; rows without a turn come first and do not count in
    ``gaps``. Rows that tie in their turn are ordered by role and digest of the text, and
    equal rows are duplicates of each other. Ids without rows give zeros, an empty audit
    and the digest of the empty text. Other columns are left out; empty input, empty result.

    One conversation may hold any share of the rows: its lattice is solved cell by cell in
    tasks of their own. Only its digest, as that of any text, is taken by one pass.
    """
    flagged = stored(faults(rows), "faults")
    counted = flagged.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1).alias("span"),
        *[F.count_if(F.col("fault") == n).alias(c) for c, n in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))],
    )
    turns = flagged.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("turn").alias("turns"))
    solved = _rewrite(rows, flagged, False)
    ids = conversations.select("conv_id").distinct()
    out = ids
    for right in (counted, turns, solved):
        out = _joined(out, right, _CONVERSATION, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "conv_id",
        zero(F.col("span") - F.col("turns")).alias("gaps"),
        *[zero(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
