"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with other
values keeps its template. Windows of template words are hash-joined between the
benchmark and the documents, and the values in the placeholders of the matches must
correspond one to one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow, stored

WIDTH = 5
COVERAGE = 0.5
# Windows with fewer plain words say too little.
LEAST_WORDS = 2
# Benchmark windows that may be sent to every task, to keep other windows out of the join.
FILTER_WINDOWS = 4_000_000

# Units of measure and currency.
UNITS = frozenset(
    "mm cm km inch inches ft feet yd yard yards mile miles mg kg tons oz lb lbs pound pounds "
    "ml cl liter liters litre litres sec seconds minute minutes hr hour hours day days week weeks "
    "month months year years hz khz mhz ghz kw mw kpa kj kcal °c °f percent % "
    "usd eur gbp dollar dollars euro euros cent cents $ € £ mph kmh km/h m/s".split()
)

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:[a-z%°/$€£]{0,6})$")
_EDGE = re.compile(r"^[^\w$€£%°+-]+|[^\w$€£%°]+$")
_PLAIN, _NUM, _UNIT = 0, 1, 2
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PLACES = {_NUM: np.uint64(0xA0761D6478BD642F), _UNIT: np.uint64(0xE7037ED1A0B428DB)}
_NAME = np.uint64(0x8EBC6AF09C88C6E3)


class _Words(dict):
    """Numbers the words seen and holds what a template needs of each; forgets when large."""

    LIMIT = 500_000
    # Hash, kind, capital first letter, end of a sentence, no letter or digit.
    TYPES = (np.uint64, np.int8, bool, bool, bool)

    def __init__(self):
        super().__init__()
        self.value: list[str] = []
        self.tables = [np.zeros(1024, t) for t in self.TYPES]

    def __missing__(self, word: str) -> int:
        # Most words are letters, perhaps with one mark behind: no pattern needed.
        if word.isalpha():
            plain = word
        elif word[-1] in ".,;:!?" and word[:-1].isalpha():
            plain = word[:-1]
        else:
            plain = _EDGE.sub("", word)
        lower = plain.lower()
        kind = _UNIT if lower in UNITS else _PLAIN
        if not plain.isalpha() and _NUMBER.match(lower):
            kind = _NUM
        literal = xxhash.xxh64_intdigest(lower.encode("utf-8", "surrogatepass"), 7)
        capital = plain[:1].isupper() and not (len(plain) > 1 and plain.isupper())
        number = self[word] = len(self.value)
        self.value.append(lower)
        if number == len(self.tables[0]):
            self.tables = [np.concatenate([t, np.zeros_like(t)]) for t in self.tables]
        row = (_PLACES.get(kind, literal), kind, capital and kind == _PLAIN, word[-1:] in ".!?:", not plain)
        for column, value in zip(self.tables, row):
            column[number] = value
        return number


def windows(words: _Words, text: str | None, width: int):
    """(hashes, usable, slot marks, word numbers) of the template windows of a text."""
    ids = np.fromiter(map(words.__getitem__, (text or "").split()), np.int64)
    hashes, kinds, capitals, stops, blanks = words.tables
    starts = np.concatenate([[True], stops[ids][:-1]]) if len(ids) else np.zeros(0, bool)
    solid = ~blanks[ids]
    # Marks without letters or digits are no words, but may end a sentence.
    ids, starts = ids[solid], starts[solid]
    n = len(ids) - width + 1
    if n <= 0:
        empty = np.zeros(0)
        return empty.astype(np.uint64), empty.astype(bool), empty.astype(bool), ids
    names = capitals[ids] & ~starts
    slot = names | (kinds[ids] != _PLAIN)
    token = np.where(names, _NAME, hashes[ids])
    value = np.zeros(n, np.uint64)
    plain = np.zeros(n, np.int16)
    for j in range(width):
        value = (value ^ token[j : j + n]) * _MULTIPLIER
        value ^= value >> np.uint64(29)
        plain += ~slot[j : j + n]
    return value, plain >= min(LEAST_WORDS, width), slot, ids


_ROW = "pos int, h long, slots array<string>"


def _rows(keys, found, names):
    """A batch of the key columns, taken per window, and the windows."""
    at, pos, h, slots = found
    taken = [k.take(pa.array(at, pa.int64())) for k in keys]
    return pa.RecordBatch.from_arrays(
        [*taken, pa.array(pos, pa.int32()), pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
        [*names, "pos", "h", "slots"],
    )


def _window_rows(width: int, wanted: np.ndarray | None):
    """Rows of all usable windows, or of those whose hash is among ``wanted`` (sorted)."""
    if wanted is not None:
        size = 1 << max(16, int(len(wanted) * 16).bit_length())
        bits = np.zeros(size, bool)
        bits[(wanted & np.uint64(size - 1)).astype(np.int64)] = True
        mask = np.uint64(size - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            names = batch.schema.names[1:]
            found, pending = ([], [], [], []), 0
            for row, text in enumerate(batch.column(0)):
                if len(words) > words.LIMIT:
                    words = _Words()
                h, usable, slot, ids = windows(words, text.as_py(), width)
                if wanted is not None and len(h):
                    usable &= bits[(h & mask).astype(np.int64)]
                hits = np.nonzero(usable)[0]
                if wanted is not None and len(hits):
                    place = np.minimum(np.searchsorted(wanted, h[hits]), len(wanted) - 1)
                    hits = hits[wanted[place] == h[hits]]
                for p in hits.tolist():
                    found[0].append(row)
                    found[1].append(p)
                    found[2].append(h[p])
                    found[3].append([words.value[ids[p + j]] for j in range(width) if slot[p + j]])
                pending += len(hits)
                if pending > 50_000:
                    yield _rows(batch.columns[1:], found, names)
                    found, pending = ([], [], [], []), 0
            yield _rows(batch.columns[1:], found, names)

    return run


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, coverage: float = COVERAGE
) -> DataFrame:
    """Rows (doc_id, text_key, item_id, matched, item_windows, coverage, kind) of leaked items.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). An item leaks into a
    document if at least ``coverage`` of its windows of ``width`` template words occur
    there with consistent placeholders: along one alignment, equal values of the item
    must stand for equal values of the document. ``kind`` is ``verbatim`` if all values
    agree, else ``reparameterised``. Windows with fewer than two plain words do not
    count; items without other windows (null, empty, or shorter than ``width`` words)
    match nothing, as do null and empty documents. Repeated documents are one row per
    item, told apart by ``text_key`` (a hash of the text); repeated items count once.
    """
    items = stored(
        map_arrow(
            benchmark.select("text", "item_id").distinct(),
            _window_rows(width, None),
            f"item_id long, {_ROW}",
        ),
        "items",
    )
    sizes = items.groupBy("item_id").agg(F.countDistinct("pos").alias("item_windows"))
    wanted = None
    hashes = items.select("h").distinct()
    if hashes.count() <= FILTER_WINDOWS:
        # At most FILTER_WINDOWS numbers; beyond that all windows take part in the join.
        table = hashes.toArrow()
        wanted = np.sort(np.asarray(table.column("h").combine_chunks()).view(np.uint64)) if table.num_rows else np.zeros(0, np.uint64)
        if not len(wanted):
            return _leaks(items.limit(0), items, sizes, coverage)
    texts = docs.select("text", "doc_id", F.xxhash64("text").alias("text_key"))
    hits = map_arrow(texts, _window_rows(width, wanted), f"doc_id long, text_key long, {_ROW}")
    return _leaks(hits, items, sizes, coverage)


def _leaks(hits: DataFrame, items: DataFrame, sizes: DataFrame, coverage: float) -> DataFrame:
    if "doc_id" not in hits.columns:
        hits = hits.select(F.col("item_id").alias("doc_id"), F.col("h").alias("text_key"), "pos", "h", "slots")
    mine = items.select("item_id", F.col("pos").alias("at"), "h", F.col("slots").alias("own"))
    pair = ["doc_id", "text_key", "item_id"]
    matched = stored(
        hits.join(mine, "h").select(*pair, (F.col("pos") - F.col("at")).alias("shift"), "at", "own", "slots"),
        "matches",
    )
    # Null ids are no join keys, so the shifts are grouped with null-safe equality below.
    aligned = [*pair, "shift"]
    values = matched.select(*aligned, F.explode(F.arrays_zip("own", "slots")).alias("v"))
    ambiguous = (
        values.groupBy(*aligned, F.col("v.own").alias("value"))
        .agg(F.countDistinct("v.slots").alias("n"))
        .filter("n > 1")
        .groupBy(*aligned)
        .agg(F.collect_set("value").alias("clashing"))
    )
    m, a = matched.alias("m"), ambiguous.alias("a")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"a.{c}")) for c in aligned]
    sound = m.join(a, same, "left").filter(
        F.col("a.clashing").isNull() | ~F.arrays_overlap("m.own", "a.clashing")
    )
    counted = sound.groupBy(*[F.col(f"m.{c}") for c in pair]).agg(
        F.countDistinct("m.at").alias("matched"),
        F.min((F.col("m.own") == F.col("m.slots")).cast("int")).alias("equal"),
    )
    return (
        counted.join(sizes, "item_id")
        .withColumn("coverage", F.col("matched") / F.col("item_windows"))
        .filter(F.col("coverage") >= coverage)
        .select(
            *pair,
            "matched",
            "item_windows",
            "coverage",
            F.when(F.col("equal") == 1, "verbatim").otherwise("reparameterised").alias("kind"),
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item of ``benchmark``; all columns kept."""
    leaks = stored(find_leaks(docs, benchmark).select("doc_id", "text_key").distinct(), "leaks")
    d, x = docs.alias("d"), leaks.alias("x")
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.xxhash64("d.text") == F.col("x.text_key"))
    return d.join(x, same, "left_anti").select("d.*")
