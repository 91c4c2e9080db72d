"""Exact clustering around centroids, with bounds that geometric drift loosens.

Vectors are packed into blocks, once. Beside each block a narrow state holds, per vector,
its cluster, an upper bound of the distance to its own centroid and a lower bound for every
other one. When the centroids move, the upper bound grows by the move of the own centroid.
A lower bound would shrink by the whole move of its centroid; but all vectors of a cluster
lie in a sphere around its centroid, and seen from there a move mostly goes sideways. In
the plane through the sphere's centre and both places of the moved centroid, the distance
to it shrinks by at most the length of the move times the cosine of the least angle between
the move and the direction, from the middle of the move, of any point of the sphere. Only
vectors whose bounds then overlap are compared with all centroids, exactly.

Blocks and states are tables in buckets of the same number by block, so that no round
shuffles anything but sums.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from math import acos, asin, cos, dist, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow, stored
from adlake.session import work_path

DIMENSIONS, SCALE = 64, 1024
# Vectors of a block, and blocks that travel to a Python worker at once.
BLOCK, BLOCKS_AT_ONCE = 1024, 8
# Components from here on could make a squared distance exceed a long.
LARGEST = 1 << 27


def whole_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, whole): the floor of ``scale`` times each component, as double.

    Vectors of another length, null ones and those that hold null or a component that is
    not finite are left out.
    """
    infinite = F.lit(float("inf"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite)
    kept = embeddings.filter((F.size("embedding") == dimensions) & F.forall("embedding", sound))
    whole = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")))
    return kept.select("vec_id", whole.alias("whole"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of least sha256 of ``seed:vec_id``; a null id is empty, ties by the vector."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name.cast("binary"), 256), "whole").limit(k).collect()
    return np.array([r["whole"] for r in rows], np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, whole) to blocks (block, ids, vectors), numbered by partition."""
    number = TaskContext.get().partitionId() << 32
    ids, vectors = [], []

    def block() -> pa.RecordBatch:
        nonlocal number, ids, vectors
        take = pa.concat_arrays(ids)
        whole = np.concatenate(vectors)
        ids, vectors = [take[BLOCK:]], [whole[BLOCK:]]
        take, whole = take[:BLOCK], whole[:BLOCK]
        if len(whole) and np.abs(whole).max() >= LARGEST:
            raise ValueError(f"a component is {LARGEST} or more after scaling: distances exceed a long")
        number += 1
        held = pa.ListArray.from_arrays(pa.array([0, len(take)], pa.int32()), take)
        values = np.ascontiguousarray(whole.astype(np.int32)).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), held, pa.array([values], pa.binary())], ["block", "ids", "vectors"]
        )

    waiting = 0
    for batch in batches:
        lists = batch.column(1)
        ids.append(batch.column(0))
        vectors.append(np.asarray(lists.flatten(), np.int64).reshape(batch.num_rows, -1))
        waiting += batch.num_rows
        while waiting >= BLOCK:
            yield block()
            waiting -= BLOCK
    if waiting:
        yield block()


def loosening(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: how much nearer centroid j can have come to a vector of cluster i.

    With m the middle of the move a -> b and x seen from m at the angle t to it, all points
    whose distances to a and b differ by at least 2d lie inside the cone of cosine d/c
    around the move (c = half its length), as a hyperbola lies inside its asymptotes. So
    |x - a| - |x - b| <= |b - a| cos t, and the least t of a sphere is the angle of its
    centre less asin(radius / distance of the centre).
    """
    k = len(before)
    out = np.zeros((k, k))
    for j in range(k):
        a, b = before[j].astype(float), after[j].astype(float)
        length = dist(a, b)
        if not length:
            continue
        middle, axis = (a + b) / 2, (b - a) / length
        for i in range(k):
            seen = before[i] - middle
            far = sqrt(float(seen @ seen))
            out[i, j] = length
            if far > radius[i]:
                least = acos(max(-1.0, min(1.0, float(seen @ axis) / far))) - asin(radius[i] / far)
                out[i, j] = length * max(0.0, cos(max(0.0, least)))
    # Rounding must not make a bound too tight.
    return out * (1 + 1e-9) + 1e-6


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, k)."""
    return np.stack([np.square(x - c).sum(axis=1) for c in centroids], axis=1)


def _up(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(np.inf))


def _down(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def _assigned(x, centroids, state, moved, loosen):
    """(cluster, upper, lower, tightened, scanned) of one block."""
    n, k = len(x), len(centroids)
    if state is None:
        squared = _distances(x, centroids)
        cluster = squared.argmin(axis=1)
        roots = np.sqrt(squared.astype(float))
        return cluster, _up(roots[np.arange(n), cluster]), _down(roots), 0, n
    cluster, upper, lower = state
    upper = _up(upper + moved[cluster])
    lower = _down(lower - loosen[cluster])
    others = lower.copy()
    others[np.arange(n), cluster] = np.inf
    nearest = others.min(axis=1)
    doubt = np.nonzero(upper >= nearest)[0]
    tightened = len(doubt)
    own = np.square(x[doubt] - centroids[cluster[doubt]]).sum(axis=1)
    upper[doubt] = _up(np.sqrt(own.astype(float)))
    doubt = doubt[upper[doubt] >= nearest[doubt]]
    squared = _distances(x[doubt], centroids)
    roots = np.sqrt(squared.astype(float))
    cluster[doubt] = squared.argmin(axis=1)
    lower[doubt] = _down(roots)
    upper[doubt] = _up(roots[np.arange(len(doubt)), cluster[doubt]])
    return cluster, upper, lower, tightened, len(doubt)


_STATE = "block long, clusters binary, uppers binary, lowers binary, sums binary, radius array<double>, tightened long, scanned long"


def _round(centroids: np.ndarray, moved: np.ndarray | None, loosen: np.ndarray | None, emit: str):
    """Assigns each block; gives its state with its sums, or its vectors with their distances."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("block")[row].as_py()
                x = np.frombuffer(batch.column("vectors")[row].as_buffer(), np.int32).reshape(-1, d).astype(np.int64)
                state = None
                if moved is not None:
                    held = [batch.column(c)[row].as_buffer() for c in ("clusters", "uppers", "lowers")]
                    state = (
                        np.frombuffer(held[0], np.int32).astype(np.int64),
                        np.frombuffer(held[1], np.float32),
                        np.frombuffer(held[2], np.float32).reshape(-1, k),
                    )
                cluster, upper, lower, tightened, scanned = _assigned(x, centroids, state, moved, loosen)
                if emit == "vectors":
                    near = np.square(x - centroids[cluster]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[row].values, pa.array(cluster, pa.int32()), pa.array(near)],
                        ["vec_id", "cluster", "distance"],
                    )
                    continue
                sums = np.zeros((k, d + 1), np.int64)
                radius = np.zeros(k)
                for c in np.unique(cluster):
                    members = cluster == c
                    sums[c, :d], sums[c, d] = x[members].sum(axis=0), members.sum()
                    radius[c] = upper[members].max()
                values = (number, cluster.astype(np.int32).tobytes(), upper.tobytes(), lower.tobytes(), sums.tobytes())
                columns = [pa.array([v], t) for v, t in zip(values, (pa.int64(), *[pa.binary()] * 4))]
                columns += [pa.array([radius.tolist()], pa.list_(pa.float64()))]
                columns += [pa.array([n], pa.int64()) for n in (tightened, scanned)]
                yield pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in _STATE.split(", ")])

    return run


def _combined(cells: int):
    """Sums of a task's blocks as rows (item, total, most); the last two items count vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, most = np.zeros(cells + 2, np.int64), np.zeros(cells + 2)
        for batch in batches:
            for row in batch.to_pylist():
                totals[:cells] += np.frombuffer(row["sums"], np.int64)
                totals[cells:] += (row["tightened"], row["scanned"])
                most[: len(row["radius"])] = np.maximum(most[: len(row["radius"])], row["radius"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(cells + 2), pa.int32()), pa.array(totals), pa.array(most)], ["item", "total", "most"]
        )

    return run


class Buckets:
    """Tables in the same number of buckets by block, below the shared folder, while in use."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.names = spark, []
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, name: str, deal: bool) -> DataFrame:
        table = f"adlake_{name}_{uuid.uuid4().hex}"
        self.names.append(table)
        dealt = df.repartition(self.count, "block") if deal else df
        path = work_path(self.spark, name)
        dealt.write.bucketBy(self.count, "block").sortBy("block").option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_: object) -> None:
        # Only the names go; the files are scratch space of the cluster.
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, report: list | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one per row of
    ``vectors`` (vec_id, whole).

    Every round assigns each vector to the nearest centroid, ties to the smaller number, and
    moves each centroid that has vectors to the floor of their mean; empty ones stay.
    Distances are squared and exact. Fewer vectors than ``k`` make as many centroids; no
    vectors, no rows. Repeated rows and null ids count like any other row. Components of
    2**27 or more after scaling stop the job, as their distances could exceed a long.

    ``report`` receives (round, vectors, tightened, scanned), how many were compared.
    """
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, k, seed)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {kind}, {columns}")
    k, d = centroids.shape
    held = f"block long, ids array<{kind}>, vectors binary"
    moved = loosen = state = None
    with Buckets(spark) as buckets:
        blocks = buckets.write(map_arrow(vectors.select("vec_id", "whole"), _packed, held), "blocks", True)
        for number in range(rounds):
            given = blocks if state is None else blocks.join(state, "block")
            fn = _round(centroids, moved, loosen, "state")
            state = buckets.write(map_arrow(given, fn, _STATE, BLOCKS_AT_ONCE), "state", False)
            partial = map_arrow(
                state.select("sums", "radius", "tightened", "scanned"),
                _combined(k * (d + 1)),
                "item int, total long, most double",
                512,
            )
            sums = partial.groupBy("item").agg(
                F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("most").alias("most")
            )
            rows = {r["item"]: r for r in sums.collect()}  # one row per component of a centroid
            cells = [int(rows[i]["total"]) for i in range(k * (d + 1))]
            counts = cells[d :: d + 1]
            after = centroids.copy()
            for c, n in enumerate(counts):
                if n:
                    after[c] = [s // n for s in cells[c * (d + 1) : c * (d + 1) + d]]
            if report is not None:
                tightened, scanned = (int(rows[k * (d + 1) + i]["total"]) for i in (0, 1))
                report.append((number, sum(counts), tightened, scanned))
            radius = np.array([rows[c]["most"] for c in range(k)])
            moved = np.array([dist(a, b) for a, b in zip(centroids.astype(float), after.astype(float))])
            moved = moved * (1 + 1e-9) + 1e-6
            loosen = loosening(centroids, after, radius)
            centroids = after
        given = blocks if state is None else blocks.join(state, "block")
        fn = _round(centroids, moved, loosen, "vectors")
        found = stored(map_arrow(given, fn, f"vec_id {kind}, cluster int, distance long", BLOCKS_AT_ONCE), "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    digests = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per_cluster = found.groupBy("cluster").agg(wide.alias("cluster_inertia")).join(named, "cluster")
    whole = found.agg(wide.alias("inertia")).scalar()
    # k rows.
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", whole.alias("inertia"), "centroid_sha256"
    )
