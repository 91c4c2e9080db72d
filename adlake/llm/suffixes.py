"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

Only suffixes that can matter are sorted: those at anchors, the positions of the least
hash of ``GRAM`` bytes inside some string of ``LENGTH`` bytes. Equal strings have their
anchor at the same place, so every repeat meets at one; suffixes at anchors whose hash
occurs once are dropped, which is the duplicate filter of prefix-doubling string sort.
Every task sorts its suffixes into runs, front-codes them (length of the prefix shared
with the suffix before, then the rest), and sends each run's part of a bucket. A bucket
is merged with a loser tree that compares only what lies behind the known common
prefixes, and yields the common prefixes of the merged order. Together with the bytes
left of the anchors these tell, for every string around an anchor, whether it occurs again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow, stored

LENGTH = 200
GRAM = 100
# Bytes hashed at once, and suffixes sorted into one run.
BUFFER = 2 << 20
RUN = 40_000
# Suffixes of a bucket, about.
BUCKET = 100_000
# Repeated hashes that the filter of one pass tells apart, and its bits for each.
FILTER_HASHES = 8_000_000
FILTER_BITS = 16

_ODD = 0x9E3779B97F4A7C15
_U = np.uint64


class _Grams:
    """Hashes of all ``gram`` bytes of a buffer, by running sums."""

    def __init__(self, gram: int):
        self.gram = gram
        rng = np.random.default_rng(20)
        self.values = rng.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.power = np.cumprod(np.concatenate([[_U(1)], np.full(BUFFER + 4096, _ODD, np.uint64)]))
        inverse = pow(_ODD, -1, 2**64)
        self.inverse = np.cumprod(np.concatenate([[_U(1)], np.full(BUFFER + 4096, inverse, np.uint64)]))

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n, k = len(data), self.gram
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.inverse[: n - k + 1]
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(29)
        return h


def anchors(grams: _Grams, data: np.ndarray, ends: np.ndarray, length: int):
    """Anchor positions and hashes of a buffer of documents that end at ``ends``."""
    n, k = len(data), grams.gram
    span = length - k + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = grams(data)
    # 40 bits of hash over 24 bits of position: ties go to the left, as in every equal string.
    low = (h & ~_U(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    windows = n - length + 1
    low = np.minimum(low[:windows], low[span - size : span - size + windows])
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(windows + 1, np.int8)
    full = ends - starts >= length
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - length + 1, -1)
    at = (low[np.cumsum(inside[:-1]) > 0] & _U(0xFFFFFF)).astype(np.int64)
    if len(at):
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return at, h[at]


def _buffers(rows: list[tuple[bytes, bytes]]) -> Iterator[list[tuple[bytes, bytes, int]]]:
    """(key, bytes, offset) pieces in buffers; a text above a buffer is cut with an overlap."""
    held, size = [], 0
    for key, data in rows:
        step = BUFFER - LENGTH
        for at in range(0, max(1, len(data)), step):
            piece = data[at : at + step + LENGTH - 1]
            if at and len(piece) < LENGTH:
                break
            if held and size + len(piece) > BUFFER:
                yield held
                held, size = [], 0
            held.append((key, piece, at))
            size += len(piece)
    if held:
        yield held


def _anchored(grams: _Grams, batch: pa.RecordBatch):
    """(document, bytes, anchors, hashes) of a batch; every anchor of a text once."""
    datas = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
    rows = [(i, d) for i, d in enumerate(datas) if len(d) >= LENGTH]
    cut: dict[int, list] = {}
    for held in _buffers(rows):
        ends = np.cumsum([len(p) for _, p, _ in held])
        at, h = anchors(grams, np.frombuffer(b"".join(p for _, p, _ in held), np.uint8), ends, LENGTH)
        split = np.searchsorted(at, ends)
        low = 0
        for (i, piece, offset), high, end in zip(held, split, ends):
            place = at[low:high] - (end - len(piece)) + offset
            if len(piece) == len(datas[i]):
                yield i, datas[i], place, h[low:high]
            else:
                cut.setdefault(i, []).append((place, h[low:high]))
            low = high
    for i, parts in cut.items():
        place, first = np.unique(np.concatenate([p for p, _ in parts]), return_index=True)
        yield i, datas[i], place, np.concatenate([h for _, h in parts])[first]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = _Grams(GRAM)
    for batch in batches:
        found = [h for _, _, _, h in _anchored(grams, batch)]
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["h"])


def _shared(strings: list[bytes], width: int) -> np.ndarray:
    """Length of the common prefix of every string with the one before."""
    n = len(strings)
    out = np.zeros(n, np.int64)
    lens = np.array([len(s) for s in strings], np.int64)
    for at in range(0, n, 4096):
        part = strings[max(0, at - 1) : at + 4096]
        grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in part), np.uint8).reshape(-1, width)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        low = max(1, at)
        out[low : low + len(first)] = first
    out[1:] = np.minimum(out[1:], np.minimum(lens[1:], lens[:-1]))
    return out


RUNS = (
    "bucket int, lcps binary, lens binary, tails binary, lefts binary, left_lens binary, "
    "members binary, keys binary, places binary, times binary"
)
_RUN_NAMES = [f.split()[0] for f in RUNS.split(", ")]


_CODEC = pa.Codec("zstd", 1)


def _unpacked(row: dict) -> dict:
    """A row of RUNS with its packed columns as they were; their sizes follow from the others."""
    rest = sum(row["lens"]) - sum(row["lcps"])
    members = int(np.frombuffer(row["members"], np.int32).sum())
    sizes = {"tails": rest, "lefts": sum(row["left_lens"]), "keys": 16 * members, "places": 8 * members}
    for name, size in sizes.items():
        row[name] = _CODEC.decompress(row[name], size, asbytes=True)
    return row


def _coded_run(entries: dict, buckets: int) -> list[list]:
    """The sorted, front-coded parts of a run, one per bucket."""
    def packed(data: bytes) -> bytes:
        return _CODEC.compress(data, asbytes=True)

    parts: dict[int, list] = {}
    for (right, left), (h, members) in entries.items():
        parts.setdefault(h % buckets, []).append((right, left, members))
    rows = []
    for bucket, part in parts.items():
        part.sort(key=lambda e: (e[0], e[1]))
        rights = [e[0] for e in part]
        lcps = _shared(rights, LENGTH)
        members = [e[2] for e in part]
        rows.append(
            [
                bucket,
                lcps.astype(np.uint8).tobytes(),
                np.array([len(r) for r in rights], np.uint8).tobytes(),
                packed(b"".join(r[c:] for r, c in zip(rights, lcps.tolist()))),
                packed(b"".join(e[1] for e in part)),
                np.array([len(e[1]) for e in part], np.uint8).tobytes(),
                np.array([len(m) for m in members], np.int32).tobytes(),
                packed(b"".join(k for m in members for k, _ in m)),
                packed(np.array([p for m in members for _, p in m], np.int64).tobytes()),
                np.array([t for m in members for t in m.values()], np.int32).tobytes(),
            ]
        )
    return rows


def _runs(bits: np.ndarray, mask: int, part: int, parts: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(GRAM)
        entries: dict = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = _coded_run(entries, buckets)
            columns = list(zip(*rows)) if rows else [[] for _ in _RUN_NAMES]
            kinds = [pa.int32()] + [pa.binary()] * (len(_RUN_NAMES) - 1)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _RUN_NAMES)

        reach = LENGTH - GRAM
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for i, data, place, h in _anchored(grams, batch):
                slot = (h & _U(mask)).astype(np.int64)
                keep = (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0) & (h % _U(parts) == _U(part))
                for p, v in zip(place[keep].tolist(), h[keep].tolist()):
                    context = (data[p : p + LENGTH], data[max(0, p - reach) : p])
                    members = entries.setdefault(context, (v >> 8, {}))[1]
                    member = (keys[i], p)
                    members[member] = members.get(member, 0) + 1
                    size += 1
                if size >= RUN:
                    yield flush()
                    entries, size = {}, 0
        yield flush()

    return run


class _Run:
    """A front-coded run: its suffixes are unpacked one after another."""

    def __init__(self, row: dict):
        self.lcps, self.lens, self.tails = row["lcps"], row["lens"], row["tails"]
        self.i, self.at, self.text = -1, 0, b""

    def next(self) -> tuple[bytes | None, int]:
        """The next suffix and what it shares with the one before."""
        self.i += 1
        if self.i >= len(self.lcps):
            return None, 0
        shared = self.lcps[self.i]
        rest = self.lens[self.i] - shared
        self.text = self.text[:shared] + self.tails[self.at : self.at + rest]
        self.at += rest
        return self.text, shared


def merge(runs: list[_Run]) -> Iterator[tuple[int, int, int]]:
    """(run, index in the run, common prefix with the suffix before) in sorted order.

    A loser tree in which every loser keeps the length of the prefix it shares with the
    winner. The head that shares more with the last output is the smaller one; only on a
    tie are bytes compared, from that length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[bytes | None] = [None] * k
    shared = [0] * k
    for s, r in enumerate(runs):
        heads[s], _ = r.next()

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        sa, sb = shared[a], shared[b]
        if sa != sb:
            return (a, b) if sa > sb else (b, a)
        n = min(len(x), len(y)) - sa
        differ = int.from_bytes(x[sa : sa + n], "big") ^ int.from_bytes(y[sa : sa + n], "big")
        common = sa + n - (differ.bit_length() + 7) // 8
        if common == len(x) or (common < len(y) and x[common] < y[common]):
            shared[b] = common
            return a, b
        shared[a] = common
        return b, a

    losers = [0] * k
    level = list(range(k))
    base = k
    while len(level) > 1:
        base //= 2
        above = []
        for j in range(0, len(level), 2):
            winner, loser = play(level[j], level[j + 1])
            losers[base + j // 2] = loser
            above.append(winner)
        level = above
    best = level[0]
    while heads[best] is not None:
        yield best, runs[best].i, shared[best]
        heads[best], shared[best] = runs[best].next()
        node = (best + k) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def repeated(lcps: np.ndarray, lens: np.ndarray, lefts: list[bytes], times: np.ndarray, length: int, reach: int):
    """For every suffix of a merged bucket and every o up to ``reach``: does the string of
    ``length`` bytes that begins o bytes left of the anchor occur again?

    Such strings are equal if the suffixes share length - o bytes and the o bytes to the
    left agree. Both are intervals of a sorted order, of the suffixes and of the reversed
    left contexts. ``times`` is how often each suffix with its left context occurs.
    """
    n = len(lcps)
    out = np.zeros((n, reach + 1), bool)
    turned = [x[::-1] for x in lefts]
    order = np.array(sorted(range(n), key=turned.__getitem__), np.int64)
    left_lens = np.array([len(x) for x in lefts], np.int64)
    left_shared = _shared([turned[i] for i in order.tolist()], max(reach, 1))
    left_class = np.zeros(n, np.int64)
    for o in range(reach + 1):
        valid = (lens >= length - o) & (left_lens >= o)
        if not valid.any():
            continue
        right_class = np.cumsum(lcps < length - o)
        left_class[order] = np.cumsum(left_shared < o) if o else 0
        pick = np.nonzero(valid)[0]
        both = right_class[pick] * (n + 1) + left_class[pick]
        _, own = np.unique(both, return_inverse=True)
        out[pick, o] = np.bincount(own, times[pick])[own] >= 2
    return out


def _cut(blob: bytes, lens: bytes) -> list[bytes]:
    edges = np.concatenate([[0], np.cumsum(np.frombuffer(lens, np.uint8).astype(np.int64))]).tolist()
    return [blob[a:b] for a, b in zip(edges, edges[1:])]


def _bucket_spans(rows: list[dict]) -> pa.RecordBatch:
    """Repeated stretches (key, start, end) that the suffixes of a bucket prove."""
    reach = LENGTH - GRAM
    merged = list(merge([_Run(r) for r in rows]))
    lcps = np.array([c for _, _, c in merged], np.int64)
    lefts_of = [_cut(r["lefts"], r["left_lens"]) for r in rows]
    lens_of = [np.frombuffer(r["lens"], np.uint8) for r in rows]
    counts_of = [np.frombuffer(r["members"], np.int32) for r in rows]
    firsts_of = [np.cumsum(c) - c for c in counts_of]
    times_of = [np.frombuffer(r["times"], np.int32) for r in rows]
    sums_of = [np.add.reduceat(t, f) for t, f in zip(times_of, firsts_of)]
    lefts = [lefts_of[s][i] for s, i, _ in merged]
    lens = np.array([lens_of[s][i] for s, i, _ in merged], np.int64)
    times = np.array([sums_of[s][i] for s, i, _ in merged], np.int64)
    # A suffix that shares fewer bytes than a gram with both neighbours repeats nothing.
    flags = np.zeros((len(merged), reach + 1), bool)
    near = lcps >= GRAM
    live = near | np.append(near[1:], False) | (times > 1)
    if live.any():
        # Between two kept suffixes the least common prefix counts, also of dropped ones.
        group = np.where(np.concatenate([[True], live[:-1]]), lcps, np.minimum(lcps, 0))
        kept = np.nonzero(live)[0]
        flags[kept] = repeated(group[kept], lens[kept], [lefts[i] for i in kept.tolist()], times[kept], LENGTH, reach)
    keys, starts, ends = [], [], []
    padded = np.zeros((len(merged), reach + 3), np.int8)
    padded[:, 1:-1] = flags
    steps = np.diff(padded, axis=1)
    at, low = np.nonzero(steps == 1)
    _, high = np.nonzero(steps == -1)
    for e, lo, hi in zip(at.tolist(), low.tolist(), (high - 1).tolist()):
        s, i, _ = merged[e]
        first, n = firsts_of[s][i], counts_of[s][i]
        places = np.frombuffer(rows[s]["places"], np.int64)[first : first + n]
        blob = rows[s]["keys"]
        keys += [blob[16 * j : 16 * j + 16] for j in range(first, first + n)]
        starts.append(places - hi)
        ends.append(places - lo + LENGTH)
    flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(flat(starts)), pa.array(flat(ends))], ["key", "begin", "end"]
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by bucket."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield _bucket_spans(held)
                held = []
            held.append(_unpacked(row))
    if held:
        yield _bucket_spans(held)


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, spans, columns ...) to (columns ..., the figures and what is left)."""
    for batch in batches:
        out = [[], [], [], [], []]
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            kept, at, runs, removed = [], 0, 0, 0
            # Overlapping and touching stretches are one run of removed bytes.
            open_from = open_to = None
            for s in sorted((x["begin"], x["end"]) for x in spans or ()):
                if open_to is not None and s[0] <= open_to:
                    open_to = max(open_to, s[1])
                    continue
                if open_to is not None:
                    kept.append(data[at:open_from])
                    at, runs, removed = open_to, runs + 1, removed + open_to - open_from
                open_from, open_to = s
            if open_to is not None:
                kept.append(data[at:open_from])
                at, runs, removed = open_to, runs + 1, removed + open_to - open_from
            kept.append(data[at:])
            left = b"".join(kept)
            for column, value in zip(out, (len(data), removed, runs, hashlib.sha256(left).hexdigest(), left)):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[2:], *[pa.array(c, k) for c, k in zip(out, kinds)]], [*batch.schema.names[2:], *names]
        )


def _filter_bits(hashes: DataFrame, size: int) -> np.ndarray:
    """A bit per hash modulo ``size``, eight to a byte; gathered as at most size / 32 words."""
    slot = F.col("h").bitwiseAND(F.lit(size - 1))
    words = (
        hashes.select(F.shiftright(slot, 5).alias("word"), F.expr(f"shiftleft(1L, cast((h & {size - 1}) & 31 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(size // 32, np.uint32)
    if words.num_rows:
        out[np.asarray(words.column("word").combine_chunks())] = np.asarray(words.column("bits").combine_chunks()).astype(np.uint32)
    return out.view(np.uint8)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Rows (key, begin, end) of repeated stretches of ``docs`` (key binary(16), text).

    ``key`` is a digest of the text. The stretches may overlap; their union is exactly the
    bytes covered by strings of ``LENGTH`` bytes that start more than once anywhere.
    """
    spark = docs.sparkSession
    counts = map_arrow(docs.select("text"), _hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    twice = stored(counts.filter("n > 1"), "repeated")
    facts = twice.agg(F.count(F.lit(1)).alias("hashes"), F.sum("n").alias("n")).first()
    # Each pass takes a share of the hashes, so that its filter has a bounded size.
    parts = max(1, -(-facts["hashes"] // FILTER_HASHES))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffles, -(-(facts["n"] or 0) // parts // BUCKET))
    size = 1 << max(12, int(FILTER_BITS * (facts["hashes"] // parts + 1)).bit_length())
    found = None
    for part in range(parts):
        mine = twice.filter(F.expr(f"(pmod(h, {parts}L) + if(h < 0, {2**64 % parts}L, 0L)) % {parts} = {part}")) if parts > 1 else twice
        runs = map_arrow(docs.select("key", "text"), _runs(_filter_bits(mine, size), size - 1, part, parts, buckets), RUNS)
        dealt = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        spans = stored(map_arrow(dealt, _merged, "key binary, begin long, end long", rows=64).distinct(), "spans")
        found = spans if found is None else found.union(spans)
    return found


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without ``text``, with the bytes that are left.

    Adds n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (binary); columns of these
    names are replaced. A byte goes if a string of ``LENGTH`` bytes that covers it also starts
    anywhere else, in the same document or another; strings do not cross documents. Null
    texts are empty; texts shorter than ``LENGTH`` keep all. Of repeated rows every one
    loses what it shares with the others. An empty input gives an empty result.
    """
    added = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text")
    rest = [f for f in docs.schema.fields if f.name not in added]
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    spans = repeated_spans(docs.select(key.alias("key"), "text"))
    # All stretches of one text: bounded by the text.
    per_text = spans.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("_spans"))
    # The columns travel as one, so that no name of theirs meets one of the join.
    row = F.struct(*[F.col(f"`{f.name}`") for f in rest])
    keyed = docs.select("text", key.alias("_key"), row.alias("_row"))
    joined = keyed.join(per_text.withColumnRenamed("key", "_key"), "_key", "left")
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
        + ["n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"]
    )
    return map_arrow(joined.select("text", "_spans", "_row.*"), _remover, schema)
