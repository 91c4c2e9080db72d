"""Near-duplicates by SimHash and deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the distance
differ by at most one bit in one segment (or joint group of segments). Every segment
is indexed once per bit with that bit deleted; equal variants are the candidates, and
each is verified on the whole fingerprint. Only distinct fingerprints take part.

The stage of the pipeline finds its candidates in the same way, by segments of a longer
fingerprint of the shingle sets, and decides by the exact similarity of the sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import key_filter, map_arrow, short_shuffles, stored, with_maybe
from adlake.llm.components import components
from adlake.session import work_path

BITS = 64
HASH_SEED = 42
# Members of one variant that a task compares with each other; larger variants are cut
# into parts of this size that meet pair by pair.
BUCKET = 2048
# Expected candidates per fingerprint above which longer keys are used.
CANDIDATES = 64
# Variants of each fingerprint that are dealt at a time.
PASS_ROWS = 64

_BYTES = np.uint64(0x0101010101010101)


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per document the bits set in over half of its hashes; no hashes: 0."""
    out = np.zeros(len(sizes), np.uint64)
    if not len(hashes):
        return out
    # Bytes are summed side by side in words, over at most 255 hashes at a time.
    ends = np.cumsum(sizes)
    starts = ends - sizes
    cuts = np.concatenate([np.arange(s, e, 255) for s, e in zip(starts, ends)])
    pieces = -(-sizes // 255)
    first = np.cumsum(pieces) - pieces
    full = sizes > 0
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _BYTES, cuts)
        lanes = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(lanes, first[full], axis=0)
        most = counts * 2 > sizes[full][:, None]
        for lane in range(8):
            out[full] |= most[:, lane].astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def shingles(text: str | None, width: int, distinct: bool) -> list[bytes]:
    """Runs of ``width`` lower-cased words; the whole sequence if it has fewer, none if empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    found = [joined[s:e] for s, e in zip(starts, (ends[width - 1 :] - 1).tolist())]
    return list(set(found)) if distinct else found


def _lanes(count: int) -> list[str]:
    return [f"_fp{i}" for i in range(count)]


def _fingerprinter(width: int, distinct: bool, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash64 = xxhash.xxh64_intdigest
        for batch in batches:
            hashes, sizes = [[] for _ in range(lanes)], []
            for text in batch.column(0):
                runs = shingles(text.as_py(), width, distinct)
                sizes.append(len(runs))
                for lane, found in enumerate(hashes):
                    seed = HASH_SEED + lane
                    found.append(np.array([hash64(s, seed) for s in runs], np.uint64))
            marks = []
            for found in hashes:
                flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                marks.append(_majority(flat, np.array(sizes, np.int64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *map(pa.array, marks)], [*batch.schema.names[1:], *_lanes(lanes)]
            )

    return run


def fingerprints(
    docs: DataFrame, width: int = 4, distinct: bool = False, lanes: int = 1
) -> DataFrame:
    """``docs`` (text, then any columns) without ``text``, with ``_fp0`` and so on (long).

    Every lane is a fingerprint of 64 bits by a hash seed of its own.
    """
    rest = [c for c in docs.columns if c not in ("text", *_lanes(lanes))]
    kept = docs.select("text", *rest)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]]
        + [f"{c} long" for c in _lanes(lanes)]
    )
    return map_arrow(kept, _fingerprinter(width, distinct, lanes), schema)


def segment_masks(distance: int, segments: int, bits: int = BITS) -> list[int]:
    """Bit masks of the keys: in one of them two fingerprints within ``distance`` differ by <= 1 bit.

    With m segments the smallest holds at most distance / m of the differing bits. If m
    exceeds the distance, m - distance segments hold none and one more at most one, so
    joint keys of m - distance + 1 segments do.
    """
    joint = max(1, segments - distance + 1)
    if distance // segments > 1:
        raise ValueError("too few segments for this distance")
    edges = [round(i * bits / segments) for i in range(segments + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, joint)]


def choose_segments(distance: int, n: int) -> int:
    """The fewest segments whose keys are long enough for ``n`` random fingerprints."""
    m = max(1, math.ceil((distance + 1) / 2))
    while m < distance + 6:
        chance = sum((k.bit_count() + 1) / 2.0 ** k.bit_count() for k in segment_masks(distance, m))
        if n * chance <= CANDIDATES:
            break
        m += 1
    return m


_LANE = 2**64 - 1


def _variants(masks: list[int], lanes: int, carried: int | None = None, at: int = 0):
    """Rows (key, node, lanes): one per mask and deleted bit; keys name both.

    ``masks`` are number ``at`` and following; the rows carry all lanes or the first ``carried``.
    """
    carried = lanes if carried is None else carried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [np.asarray(batch.column(c)).view(np.uint64) for c in _lanes(lanes)]
            kept = batch.select(["node", *_lanes(carried)])
            for number, mask in enumerate(masks, at):
                bits = [b for b in range(BITS * lanes) if mask >> b & 1]
                for bit in bits:
                    rest = mask & ~(1 << bit)
                    # Multiplications mix the key's place into all bits.
                    place = (0x9E3779B97F4A7C15 * (number * BITS * lanes + bit + 1)) & _LANE
                    key = np.full(batch.num_rows, place, np.uint64)
                    for lane, fp in enumerate(fps):
                        deleted = np.uint64(rest >> (BITS * lane) & _LANE)
                        if deleted:
                            key ^= (fp & deleted) * np.uint64(0xD6E8FEB86659FD93 + 2 * lane)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), *kept.columns], ["key", *kept.schema.names]
                    )

    return run


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of all a[i] and b[i]; every member points at the smallest of its set."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        # One new parent for each root; what that leaves open comes again.
        parent[np.maximum(ra, rb)] = np.minimum(ra, rb)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _star(nodes: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each member with the smallest of its set: fewer rows than members, however many links."""
    moved = np.nonzero(parent != np.arange(len(parent)))[0]
    return nodes[moved], nodes[parent[moved]]


def _apart(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Differing bits over all lanes."""
    return sum(np.bitwise_count(a ^ b).astype(np.int16) for a, b in zip(x, y))


def _sets_between(x: list[np.ndarray], y: list[np.ndarray] | None, distance: int) -> np.ndarray:
    """The sets that links within ``distance`` among x, or between x and y, make.

    Gives the parents of the members of x, or of x followed by y.
    """
    n = len(x[0])
    parent = np.arange(n if y is None else n + len(y[0]))
    other, shift = (x, 0) if y is None else (y, n)
    for at in range(0, n, 512):
        near = _apart([v[at : at + 512, None] for v in x], [v[None, :] for v in other]) <= distance
        i, j = np.nonzero(near)
        parent = _union(parent, i + at, j + shift)
    return parent


LINK, LARGE = 0, 1


def _batch(lanes, a, b, kind, key, fps=None) -> pa.RecordBatch:
    n = len(a)
    zeros = np.zeros(n, np.int64)
    given = [f.view(np.int64) for f in fps] if fps else [zeros] * lanes
    columns = [np.asarray(a), np.asarray(b), np.full(n, kind, np.int8), np.full(n, key, np.int64), *given]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "kind", "key", *_lanes(lanes)])


def _bucket_links(distance: int, lanes: int):
    """What the links inside the variants of a partition sorted by key connect.

    The members of small variants are compared in passes over the whole batch, each with
    the one ``step`` rows on, unless both have the same node. A variant above ``BUCKET`` members
    is passed on row by row, numbered, after its members have been compared with the first.
    """

    def small(key, node, *fps):
        nodes, own = np.unique(node, return_inverse=True)
        parent = np.arange(len(nodes))
        step = 1
        while step < len(key):
            i = np.nonzero(key[step:] == key[:-step])[0]
            if not len(i):
                break
            i = i[node[i] != node[i + step]]
            x, y = [f[i] for f in fps], [f[i + step] for f in fps]
            near = i[_apart(x, y) <= distance]
            parent = _union(parent, own[near], own[near + step])
            step += 1
        yield _batch(lanes, *_star(nodes, parent), LINK, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        large = None  # the key of a variant that is being passed on
        first, passed = None, 0  # its first member, and how many rows have been passed on

        def members(key, node, fps):
            nonlocal passed
            near = _apart(fps, [f[None] for f in first[1:]]) <= distance
            to = np.unique(node[near & (node != first[0])])
            numbers = np.arange(passed, passed + len(node))
            passed += len(node)
            return [
                _batch(lanes, to, np.full(len(to), first[0]), LINK, 0),
                _batch(lanes, numbers, node, LARGE, key, fps),
            ]

        def split(cols, last: bool):
            nonlocal large, first
            out = []
            if large is not None:
                n = int(np.searchsorted(cols[0], large, "right"))
                if n:
                    out += members(large, cols[1][:n], [f[:n] for f in cols[2:]])
                cols = [c[n:] for c in cols]
                if len(cols[0]):
                    large = None
            key, node, *fps = cols
            if not len(key):
                return out, cols
            starts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1])
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            keep = np.ones(len(key), bool)
            for s, n in zip(starts[sizes > BUCKET], sizes[sizes > BUCKET]):
                part = slice(s, s + n)
                keep[part] = False
                open_end = s + n == len(key)
                if open_end or (node[part] != node[s]).any():
                    first = [node[s], *[f[s] for f in fps]]
                    out += members(key[s], node[part], [f[part] for f in fps])
                if open_end:
                    large = key[s]
            hold = len(key)
            if not last and large is None:
                hold = int(starts[-1])
            done = keep.copy()
            done[hold:] = False
            out += list(small(*[c[done] for c in cols]))
            return out, [c[hold:] for c in cols]

        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns[:2]]
            cols += [np.asarray(batch.column(c)).view(np.uint64) for c in _lanes(lanes)]
            out, rest = split([np.concatenate(p) for p in zip(rest, cols)] if rest else cols, False)
            yield from out
        if rest:
            yield from split(rest, True)[0]

    return run


def _part_links(distance: int, lanes: int):
    """Rows (i, j, xs, ys): the links between two parts of a large variant."""

    def side(values) -> tuple[np.ndarray, list[np.ndarray]]:
        fields = [np.asarray(values.field(c)) for c in ["node", *_lanes(lanes)]]
        return fields[0], [f.view(np.uint64) for f in fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                node, xs = side(batch.column("xs")[r].values)
                if batch.column("i")[r].as_py() == batch.column("j")[r].as_py():
                    parent = _sets_between(xs, None, distance)
                else:
                    other, ys = side(batch.column("ys")[r].values)
                    node = np.concatenate([node, other])
                    parent = _sets_between(xs, ys, distance)
                yield _batch(lanes, *_star(node, parent), LINK, 0)

    return run


def links(
    distinct_fps: DataFrame, distance: int, masks: list[int], lanes: int = 1, carried: int | None = None
) -> DataFrame:
    """Rows (a, b) of nodes that connect the fingerprints (node, lanes) within ``distance``.

    Nodes that share a variant of ``masks`` are compared, on all lanes or on the first
    ``carried``. Pairs are not listed one by one: every task gives each node the smallest one
    that its links reach, so that a group of n nodes gives rows in proportion to n. What
    pairs within the distance that share a variant connect, the rows connect.

    ``PASS_ROWS`` variants of each fingerprint are dealt at a time, so that the disk holds
    those of one pass only. If that takes several passes, the first has one mask alone, and
    what it links goes by the name of its smallest neighbour in the others. So a large group
    gives each of its members rows from one mask, not from all.
    """
    spark = distinct_fps.sparkSession
    carried = lanes if carried is None else carried
    names = _lanes(carried)
    values = ", ".join(f"{c} long" for c in names)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = f"a long, b long, kind byte, key long, {values}"
    folder, paths, at = work_path(spark, "links"), [], 0
    renamed = None
    several = sum(m.bit_count() for m in masks) > PASS_ROWS
    while at < len(masks):
        some = [masks[at]]
        while (at or not several) and at + len(some) < len(masks) and sum(m.bit_count() for m in some) + masks[at + len(some)].bit_count() <= PASS_ROWS:
            some.append(masks[at + len(some)])
        spread = map_arrow(
            distinct_fps.select("node", *_lanes(lanes)),
            _variants(some, lanes, carried, at),
            f"key long, node long, {values}",
            rows=8192,
        )
        dealt = spread.repartition(parts, "key").sortWithinPartitions("key")
        paths.append(f"{folder}/{at}")
        with short_shuffles(spark):
            map_arrow(dealt, _bucket_links(distance, carried), row, rows=65536).write.parquet(paths[-1])
        if several and not at:
            one = spark.read.schema(row).parquet(paths[0])
            least = one.filter(F.col("kind") == LINK).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            called = F.coalesce("least", "node")
            distinct_fps = stored(
                distinct_fps.select("node", *_lanes(lanes))
                .join(least, "node", "left")
                .select(F.col("node").alias("was"), called.alias("node"), *_lanes(lanes)),
                "named",
            )
            # The members of large variants go by their new names as well.
            names_of = distinct_fps.select(F.col("was").alias("b"), F.col("node").alias("name"))
            renamed = one.filter(F.col("kind") == LARGE).join(names_of, "b").drop("b").withColumnRenamed("name", "b")
            renamed = stored(renamed, "renamed")
        at += len(some)
    # All passes are one scan: in a union of scans the plan would grow with the passes.
    small = spark.read.schema(row).parquet(*paths).filter(F.col("kind") == LINK).select("a", "b")
    found = renamed
    if later := paths[1:] if several else paths:
        found = spark.read.schema(row).parquet(*later).filter(F.col("kind") == LARGE)
        found = found.unionByName(renamed) if several else found
    # Large variants of several nodes: parts of bounded size meet pair by pair, in tasks of their own.
    rows = found.select("key", F.col("a").alias("number"), F.col("b").alias("node"), *names)
    counts = (
        rows.groupBy("key")
        .agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("parts"), F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low < high")
        .select("key", "parts")
    )
    part = F.pmod(F.xxhash64("number"), F.col("parts")).cast("int")
    members = rows.join(counts, "key").withColumn("part", part)
    packed = stored(
        members.groupBy("key", "part", "parts").agg(F.collect_list(F.struct("node", *names)).alias("fps")),
        "parts",
    )
    left = packed.select(
        "key",
        F.col("part").alias("i"),
        F.col("fps").alias("xs"),
        F.explode(F.sequence("part", F.col("parts") - 1)).alias("j"),
    )
    right = packed.select("key", F.col("part").alias("j"), F.col("fps").alias("ys"))
    pairs = left.join(right, ["key", "j"]).repartition(parts, "key", "i", "j")
    large = map_arrow(pairs, _part_links(distance, carried), row, rows=4)
    return small.union(large.select("a", "b"))


def classes(
    prints: DataFrame, distance: int = 4, segments: int | None = None, lanes: int = 1, sure: int | None = None
) -> DataFrame:
    """``prints`` (doc_id, lanes, ...) with ``component_id``, the smallest doc_id reachable.

    Fingerprints link within ``distance`` differing bits. The keys find every pair within
    ``sure`` bits (by default the distance, so that none is missed), and others as far as
    one of their segments happens to differ by at most one bit. ``segments`` defaults to
    the fewest whose keys keep chance candidates rare for the number of fingerprints.

    Rows of equal fingerprints are linked, those of null doc_id too; they never name a
    class unless no member has an id, which makes the id null.
    """
    names = _lanes(lanes)
    sure = distance if sure is None else sure
    node = F.col(names[0]) if lanes == 1 else F.xxhash64(*names)
    per_print = stored(
        prints.groupBy(*names).agg(F.min("doc_id").alias("first")).withColumn("node", node), "prints"
    )
    segments = segments or choose_segments(sure, per_print.count())
    masks = segment_masks(sure, segments, BITS * lanes)
    found = components(links(per_print, distance, masks, lanes))
    groups = per_print.join(found, "node", "left").select(
        *names, F.coalesce("component", "node").alias("root"), "first"
    )
    least = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    named = groups.join(least, "root").select(*names, "component_id")
    rest = [c for c in prints.columns if c != "component_id"]
    return prints.select(*rest).join(named, names)


def near_duplicates(
    docs: DataFrame, width: int = 4, distance: int = 4, distinct: bool = False
) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text, ...).

    Words are lower-cased (A-Z only) and split at ASCII blanks; shingles count as often as
    they occur unless ``distinct``. Texts of fewer words than ``width`` are one shingle;
    null and blank texts have fingerprint zero and are linked like any other. Repeated
    rows give repeated results; other columns are left out. Empty input, empty result.
    """
    prints = stored(fingerprints(docs.select("doc_id", "text"), width, distinct), "fps")
    named = classes(prints, distance)
    hexed = F.lower(F.lpad(F.hex("_fp0"), 16, "0"))
    return named.select("doc_id", hexed.alias("fingerprint"), "component_id")


# The stage of the pipeline: shingle sets are near copies from this similarity on (4 of 5).
SIMILAR = (4, 5)
# Members and shingles of a candidate group that a task compares with as many others;
# larger groups are cut into such parts that meet pair by pair.
PART, PART_SHINGLES = 4096, 1 << 21
# Sets of each larger group that all its members are compared with first, and how often.
PIVOTS, PIVOT_TURNS = 4, 2


# Candidates share a variant, so one of their segments differs by at most one bit. Bits of
# two sets differ with the probability of the angle between them over pi, 0.152 at 0.8. There
# are so many segments that all but this share of the pairs at that limit share a variant.
MISSED = 5e-8
# Bits of a segment, and one more whenever a variant would have more members by chance.
SEGMENT, MEMBERS = 16, 64
# Of the first 384 bits of such a pair 58 differ in the mean; pairs that differ in more than
# this (7 standard deviations) are no candidates. Sets that share nothing differ in 192. So
# many bits are carried as chance candidates, whose number per set grows with the table,
# would connect its groups to one group of most sets.
CARRIED, APART = 6, 107
# Sets of up to so many shingles with a similarity of 0.8 are equal but for one shingle, which
# is left out like a bit: their variants are the sets without one. Others up to the second
# number have no larger partner.
SHORT, ALONE = 8, 7


def set_segments(n: int) -> list[int]:
    """Masks of the segments for ``n`` shingle sets: as many as ``MISSED`` asks for, apart from each other."""
    least, whole = SIMILAR
    flip = math.acos(2 * least / (least + whole)) / math.pi
    size = SEGMENT + max(0, math.ceil(math.log2(max(n, 1) / MEMBERS)) - SEGMENT + 1)
    near = (1 - flip) ** size + size * flip * (1 - flip) ** (size - 1)
    count = math.ceil(math.log(MISSED) / math.log1p(-near))
    return [((1 << size) - 1) << (size * i) for i in range(count)]


def _constants(name: bytes, count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(name + b"%d" % i, HASH_SEED) for i in range(count)], np.uint64)


_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(hashes: np.ndarray, added: np.uint64) -> np.ndarray:
    """A hash of the hashes for each lane."""
    out = (hashes + added) * _MIX
    for _ in range(2):
        out ^= out >> np.uint64(32)
        out *= _MIX
    return out ^ out >> np.uint64(32)


def _digest(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), HASH_SEED)


def _set_prints(width: int, lanes: int):
    """(text, columns ...) to (columns ..., node, size, subsets, lanes); ``node`` names the shingle set.

    ``subsets`` are the variants of a short set: itself, and it without each of its shingles.
    """
    added = _constants(b"lane", lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets, subsets = [], [], []
            for text in batch.column(0):
                runs = shingles(text.as_py(), width, True)
                hashes = np.array([xxhash.xxh64_intdigest(s, HASH_SEED) for s in runs], np.uint64)
                hashes.sort()
                nodes.append(_digest(hashes))
                sets.append(hashes)
                short = SIMILAR[0] <= len(hashes) <= SHORT
                subsets.append([nodes[-1], *(_digest(np.delete(hashes, i)) for i in range(len(hashes)))] if short else [])
            sizes = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            marks = [_majority(_mixed(flat, a), sizes).view(np.int64) for a in added]
            ends = np.cumsum([0, *map(len, subsets)]).astype(np.int32)
            keys = np.array([k for some in subsets for k in some], np.uint64).view(np.int64)
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes)]
            columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)), *map(pa.array, marks)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *columns],
                [*batch.schema.names[1:], "node", "size", "subsets", *_lanes(lanes)],
            )

    return run


def set_candidates(per_set: DataFrame, masks: list[int], lanes: int) -> DataFrame:
    """Rows (a, b) that connect the sets (node, size, subsets, lanes) which share a variant."""
    short = per_set.select(F.explode("subsets").alias("key"), "node")
    firsts = short.groupBy("key").agg(F.min("node").alias("first"))
    alike = short.join(firsts, "key").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    long = per_set.filter(F.col("size") > ALONE).select("node", *_lanes(lanes))
    return alike.union(links(long, APART, masks, lanes, CARRIED))


def _set_hashes(width: int):
    """(text, columns ...) to (columns ..., hashes): the shingle set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                np.array([xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles(t.as_py(), width, True)], np.uint64)
                for t in batch.column(0)
            ]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], [*batch.schema.names[1:], "hashes"])

    return run


def _similar_sets(sets: list[np.ndarray], roots: list[int], sides: list[int]) -> np.ndarray:
    """Parents of the sets that pairs of a similarity of at least ``SIMILAR`` connect.

    Every pair is decided by its exact similarity, except those already connected, as sets
    of one root are from the start, and those of one side (0 or 1; 2 is on no side).
    """
    least, whole = SIMILAR
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(ids), bool)
    _, first, own = np.unique(roots, return_index=True, return_inverse=True)
    parent = first[own]
    side = np.array(sides)
    for i in range(len(sets) - 1):
        rest = np.nonzero(parent[i + 1 :] != parent[i])[0] + i + 1
        if side[i] < 2:
            rest = rest[side[rest] != side[i]]
        low, high = np.minimum(sizes[i], sizes[rest]), np.maximum(sizes[i], sizes[rest])
        rest = rest[(low * whole >= high * least) & (low > 0)]
        if not len(rest):
            continue
        own = ids[starts[i] : starts[i] + sizes[i]]
        held[own] = True
        firsts = np.cumsum(sizes[rest]) - sizes[rest]
        at = np.repeat(starts[rest] - firsts, sizes[rest]) + np.arange(sizes[rest].sum())
        common = np.add.reduceat(held[ids[at]].astype(np.int64), firsts)
        held[own] = False
        near = rest[common * (least + whole) >= least * (sizes[i] + sizes[rest])]
        parent = _union(parent, np.full(len(near), i), near)
    return parent


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b) that connect the similar sets of each group, over rows sorted by group."""

    def links_of(nodes: list[int], *held: list) -> pa.RecordBatch:
        a, b = _star(np.array(nodes, np.int64), _similar_sets(*held))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    group, nodes, sets, roots, sides = None, [], [], [], []
    for batch in batches:
        names = list(zip(*[batch.column(c).to_pylist() for c in ("component", "i", "j")]))
        for r, name in enumerate(names):
            if name != group:
                if len(nodes) > 1:
                    yield links_of(nodes, sets, roots, sides)
                group, nodes, sets, roots, sides = name, [], [], [], []
            nodes.append(batch.column("node")[r].as_py())
            roots.append(batch.column("root")[r].as_py())
            sides.append(batch.column("side")[r].as_py())
            sets.append(np.array(batch.column("hashes")[r].values))
    if len(nodes) > 1:
        yield links_of(nodes, sets, roots, sides)


def _parts() -> Column:
    """How many parts a group needs so that a task holds a bounded number of sets and shingles."""
    return F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / PART), F.ceil(F.sum("size") / PART_SHINGLES)).cast("int")


def _compared(met: DataFrame) -> DataFrame:
    """Links within the groups (component, i, j) of ``met`` (node, root, side, hashes, component, i, j)."""
    shuffles = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = met.select("component", "i", "j", "node", "root", "side", "hashes")
    dealt = row.repartition(shuffles, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    return map_arrow(dealt, _group_links, "a long, b long")


def _pivot_links(pool: DataFrame, sets: DataFrame, turn: int) -> DataFrame:
    """Links of every set to the similar ones among its group's pivots, drawn from ``pool``.

    The pivots are copied to every part of their group, so no task holds a hot group.
    """
    draw = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")
    slot = F.pmod(F.xxhash64("node", F.lit(-turn - 1)), F.lit(PIVOTS))
    chosen = pool.groupBy("component", slot.alias("slot")).agg(F.min(draw)["node"].alias("node"))
    pivots = stored(chosen.select("node").join(sets.select("node", "component", "parts", "size", "hashes"), "node"), "pivots")
    spread = pivots.select(
        "component",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("node").alias("pivot"),
        F.col("size").alias("pivot_size"),
        F.col("hashes").alias("pivot_hashes"),
    )
    least, whole = SIMILAR
    low, high = F.least("size", "pivot_size"), F.greatest("size", "pivot_size")
    common = F.size(F.array_intersect("hashes", "pivot_hashes"))
    near = (low * whole >= high * least) & (low > 0)
    return (
        sets.join(spread, ["component", "part"])
        .filter((F.col("node") != F.col("pivot")) & near)
        .filter(common * (least + whole) >= F.lit(least) * (F.col("size") + F.col("pivot_size")))
        .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    )


def _large_links(sets: DataFrame) -> DataFrame:
    """Links within groups of several parts: ``sets`` (node, component, parts, part, size, hashes).

    Sets are first compared with a few pivots of their group. That mostly connects a group
    of copies, and what it connects need not meet again: only the sets outside the largest
    class of their group are compared with all parts of it, and with each other.
    """
    links = None
    pool = sets
    for turn in range(PIVOT_TURNS):
        found = _pivot_links(pool, sets, turn)
        links = stored(found if links is None else links.union(found), "pivot-links")
        named = components(links).withColumnRenamed("component", "component_of")
        rooted = stored(
            sets.select("node", "component", "size").join(named, "node", "left").select(
                "node", "component", "size", F.coalesce("component_of", "node").alias("root")
            ),
            "rooted",
        )
        # Partial sums per class and task: no task lists a group.
        counts = rooted.groupBy("component", "root").agg(F.count(F.lit(1)).alias("n"))
        main = counts.groupBy("component").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
        marked = rooted.join(main, "component").withColumn("rest", F.col("root") != F.col("main"))
        pool = marked.filter("rest").select("node", "component")
    marked = stored(marked, "marked")
    rests = marked.filter("rest").groupBy("component").agg(_parts().alias("rest_parts"))
    sizes = marked.groupBy("component").agg(_parts().alias("all_parts"))
    # Groups that one class fills are done.
    open_groups = rests.join(sizes, "component")
    flagged = (
        sets.select("node", "component", "hashes")
        .join(marked.select("node", "root", "rest"), "node")
        .join(open_groups, "component")
    )
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("rest_parts")).otherwise(F.col("all_parts"))).cast("int")
    placed = stored(flagged.withColumn("part", own), "placed")
    last_rest = F.col("rest_parts") - 1
    rest = placed.filter("rest")
    # Part i of the rest meets every other part of the rest, and every part j of the class.
    others = rest.withColumn("other", F.explode(F.sequence(F.lit(0), last_rest))).select(
        "node", "root", F.lit(2).alias("side"), "hashes", "component",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    )
    inward = rest.select(
        "node", "root", F.lit(1).alias("side"), "hashes", "component", F.col("part").alias("i"),
        F.explode(F.sequence(-F.col("all_parts"), F.lit(-1))).alias("j"),
    )
    outward = placed.filter("not rest").select(
        "node", "root", F.lit(0).alias("side"), "hashes", "component",
        F.explode(F.sequence(F.lit(0), last_rest)).alias("i"), (-1 - F.col("part")).alias("j"),
    )
    return links.union(_compared(others.union(inward).union(outward)))


def similar_links(prints: DataFrame, candidates: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Rows (a, b) that connect the nodes whose shingle sets are similar.

    ``prints`` has one row (node, size, text_key) per set, ``candidates`` (a, b) connect the
    nodes to compare, ``texts`` holds (text, text_key). Within what the candidates connect,
    every pair is decided by its exact similarity, whether it was a candidate or not, unless
    similar pairs connect it already.
    """
    found = components(candidates)
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    members = stored(found.select("node", "component").union(roots).join(prints, "node"), "members")
    counts = members.groupBy("component").agg(_parts().alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = members.join(counts, "component").select(
        "node", "component", "text_key", "size", "parts", part.alias("part")
    )
    # One text for each set: copies of a text share its key. Texts that are in no group stay out.
    wanted = key_filter(members, F.col("text_key"))
    some = with_maybe(texts, F.col("text_key"), wanted).filter("_maybe").select("text", "text_key")
    read = placed.join(some, "text_key").dropDuplicates(["node"])
    names = ("node", "component", "size", "parts", "part")
    schema = "node long, component long, size long, parts int, part int, hashes array<long>"
    sets = map_arrow(read.select("text", *names), _set_hashes(width), schema)
    large = not counts.filter("parts > 1").isEmpty()
    if large:
        sets = stored(sets, "sets")
    zero = F.lit(0).alias("i"), F.lit(0).alias("j")
    alone = F.col("node").alias("root"), F.lit(2).alias("side")
    small = sets.filter("parts = 1").select("node", *alone, "hashes", "component", *zero)
    links = _compared(small)
    return links.union(_large_links(sets.filter("parts > 1"))) if large else links


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one row per class of near-duplicates: the one of smallest doc_id.

    Two texts are near-duplicates if the exact similarity (Jaccard) of their sets of
    shingles is at least ``SIMILAR``; a class is what such pairs connect. Candidates share a
    deletion variant of one of the segments of their SimHash (``set_segments``) and differ in
    at most ``APART`` of its first bits. Each distinct shingle counts once, so that a line
    repeated in a text does not stand for the whole.

    Texts without words form one class. Null ids come after all others; among equal ids the
    text with the smaller hash stays. Of rows with equal doc_id and text one stays. A text
    that shares its doc_id with a near-duplicate of others is judged by itself. All columns
    are kept.
    """
    masks = set_segments(docs.count())
    lanes = math.ceil(masks[-1].bit_length() / BITS)
    names = _lanes(lanes)
    text_key = F.xxhash64("text").alias("text_key")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key long, node long, size long, subsets array<long>, " + ", ".join(f"{c} long" for c in names)
    prints = stored(map_arrow(docs.select("text", "doc_id", text_key), _set_prints(width, lanes), schema), "fps")
    firsts = [F.first(c).alias(c) for c in ("size", "subsets", *names)]
    per_set = stored(prints.groupBy("node").agg(F.min("text_key").alias("text_key"), *firsts), "prints")
    near = set_candidates(per_set, masks, lanes)
    found = components(similar_links(per_set.select("node", "size", "text_key"), near, docs.select("text", text_key), width))
    rooted = prints.select("doc_id", "text_key", "node").join(found, "node", "left")
    named = stored(rooted.select("doc_id", "text_key", F.coalesce("component", "node").alias("root")), "classes")
    # Ids may be shared by different texts, so a row is named by both; nulls come last.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    least = named.groupBy("root").agg(F.min(place).alias("least"))
    losers = named.join(least, "root").filter(place != F.col("least"))
    losers = stored(losers.select("doc_id", "text_key").distinct(), "losers")
    twice = named.groupBy("doc_id", "text_key").count().filter("count > 1")
    if not twice.isEmpty():
        docs = docs.dropDuplicates(["doc_id", "text"])
    # Rows that stay for certain do not move; the columns travel as one, whatever their names.
    key = F.xxhash64("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), key.alias("key"))
    marked = with_maybe(rows, F.xxhash64("id", "key"), key_filter(losers, F.xxhash64("doc_id", "text_key")))
    gone = losers.toDF("gone_id", "gone_key")
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    checked = marked.filter("_maybe").join(gone, same, "left_anti")
    return marked.filter("not _maybe").union(checked).select("row.*")
