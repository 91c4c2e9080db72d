"""Audience segments: k-means over user features, and their profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalars import rounded
from adlake.operators.ordered import share_of_total, top_n
from adlake.operators.sampling import unit_hash
from adlake.plans.ctr_model import scale, scaler_statistics
from adlake.session import materialize

FEATURES = (
    "impressions",
    "clicks",
    "conversions",
    "total_revenue",
    "avg_ctr_score",
    "days_since_signup",
)
ATTRIBUTES = ("user_id", "region", "device", "subscription_tier")

# Presentation names of the four clusters.
CLUSTER_LABELS = {0: "Dormant", 1: "Casual Viewers", 2: "High Value", 3: "Active Earners"}

Centers = Sequence[Sequence[float]]

GOLDEN = 0.6180339887498949
# Rows of drawn batches that one partition holds.
PARTITION_ROWS = 100_000


def model_input(features: DataFrame) -> DataFrame:
    """User attributes and the clustering features as doubles, missing values as 0."""
    return features.select(
        *ATTRIBUTES, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    )


def standardize(rows: DataFrame, columns: tuple[str, ...] = FEATURES) -> DataFrame:
    """Columns minus mean over population deviation (1 where a column is constant)."""
    return scale(rows, scaler_statistics(rows, columns))


def _squared_distances(centers: Centers, columns: Sequence[str]) -> list[Column]:
    return [
        reduce(
            Column.__add__,
            [F.pow(F.col(c) - F.lit(float(x)), F.lit(2.0)) for c, x in zip(columns, center)],
        )
        for center in centers
    ]


def nearest_center(
    points: DataFrame, centers: Centers, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Add ``user_cluster`` (the nearest centre, the first on ties) and ``distance_sq``."""
    with_all = points.withColumn("_d", F.array(*_squared_distances(centers, columns)))
    nearest = F.array_min("_d")
    return (
        with_all.withColumn("distance_sq", nearest)
        .withColumn("user_cluster", (F.array_position("_d", F.col("distance_sq")) - 1).cast("int"))
        .drop("_d")
    )


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("distance_sq").alias("inertia"), F.count(F.lit(1)).alias("points"))


def fit_centers(
    points: DataFrame, k: int = 4, seed: int = 42, columns: Sequence[str] = FEATURES
) -> list[list[float]]:
    """Centres by parallel k-means over all points."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(points)
    model = KMeans(k=k, seed=seed, initMode="k-means||", featuresCol="features").fit(
        vectors.select("features")
    )
    return [[float(x) for x in center] for center in model.clusterCenters()]


def seed_centers(
    points: DataFrame,
    k: int = 4,
    seed: int = 42,
    columns: Sequence[str] = FEATURES,
    row_id: str = "user_id",
) -> list[list[float]]:
    """k-means++ seeds: each next centre drawn with weight = squared distance so far.

    A weighted draw is the smallest ``-ln(u) / weight`` over all rows, so each of the
    k draws is one distributed top-1.
    """
    centers: list[list[float]] = []
    for turn in range(k):
        weight = (
            F.array_min(F.array(*_squared_distances(centers, columns))) if centers else F.lit(1.0)
        )
        ticket = -F.ln(unit_hash(row_id, seed, turn)) / weight
        drawn = (
            points.withColumn("_weight", weight)
            .filter(F.col("_weight") > 0)
            .orderBy(ticket, row_id)
            .select(*columns)
            .first()
        )
        if drawn is None:  # fewer distinct points than centres
            break
        centers.append([float(x) for x in drawn])
    return centers


def minibatch_step(
    batch: DataFrame,
    centers: Centers,
    counts: Sequence[int],
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """One mini-batch update: rows (user_cluster, batch_rows, seen, one column per feature).

    Moving a centre to each of its points at rate 1 / count is a running mean, so the
    new centre is (old * seen + sum of points) / (seen + points). A centre without
    points in the batch gets no row and stays as it is.
    """
    seen = F.get(F.array(*[F.lit(int(n)) for n in counts]), F.col("user_cluster"))
    sums = (
        nearest_center(batch, centers, columns)
        .groupBy("user_cluster")
        .agg(
            F.count(F.lit(1)).alias("batch_rows"),
            *[F.sum(c).alias(c) for c in columns],
        )
    )
    moved = {}
    for i, c in enumerate(columns):
        olds = F.array(*[F.lit(float(center[i])) for center in centers])
        old = F.get(olds, F.col("user_cluster"))
        moved[c] = (old * seen + F.col(c)) / (seen + F.col("batch_rows"))
    return sums.select(
        "user_cluster",
        "batch_rows",
        (seen + F.col("batch_rows")).alias("seen"),
        *[expr.alias(c) for c, expr in moved.items()],
    )


def draw_batches(
    points: DataFrame,
    batch_size: int = 512,
    batches: int = 80,
    seed: int = 42,
    row_id: str = "user_id",
) -> DataFrame:
    """Rows with a ``batch`` number; each batch takes about ``batch_size`` rows.

    One pass over the points draws all batches: a row falls into each batch with
    probability batch_size / rows. Its hashed id, turned by the golden ratio from batch to
    batch, decides.
    """
    share = min(1.0, batch_size / max(1, points.count()))
    numbers = F.sequence(F.lit(0), F.lit(batches - 1))
    place = F.col("_place")
    drawn = F.filter(numbers, lambda b: F.pmod(place + b * GOLDEN, F.lit(1.0)) < share)
    return (
        points.withColumn("_place", unit_hash(row_id, seed))
        .withColumn("batch", F.explode(drawn))
        .drop("_place")
    )


def fit_centers_minibatch(
    points: DataFrame,
    k: int = 4,
    batch_size: int = 512,
    batches: int = 80,
    seed: int = 42,
    columns: Sequence[str] = FEATURES,
    row_id: str = "user_id",
) -> list[list[float]]:
    """Centres by mini-batch k-means. Only the k centres pass through the driver."""
    centers = seed_centers(points, k, seed, columns, row_id)
    counts = [0] * len(centers)
    # The batches are small whatever the number of points.
    parts = max(1, batch_size * batches // PARTITION_ROWS)
    drawn = materialize(
        draw_batches(points, batch_size, batches, seed, row_id)
        .select("batch", *columns)
        .repartition(parts, "batch")
    )
    for number in range(batches):
        batch = drawn.filter(F.col("batch") == number)
        for row in minibatch_step(batch, centers, counts, columns).collect():
            centers[row["user_cluster"]] = [row[c] for c in columns]
            counts[row["user_cluster"]] = row["seen"]
    return centers


TRAINERS = {"parallel": fit_centers, "minibatch": fit_centers_minibatch}


def assign_segments(
    features: DataFrame,
    centers: Centers | None = None,
    k: int = 4,
    seed: int = 42,
    trainer: str = "parallel",
) -> DataFrame:
    """User attributes, features (unscaled) and ``user_cluster``.

    ``centers`` are in standardized units; by default ``trainer`` fits them: ``parallel``
    (k-means over all points) or ``minibatch``. The input is stored first, as the
    statistics, the fit and the assignment all read it.
    """
    rows = materialize(model_input(features))
    scaled = scale(
        rows.withColumns({f"_raw_{c}": F.col(c) for c in FEATURES}),
        scaler_statistics(rows, FEATURES),
    )
    if centers is None:
        centers = TRAINERS[trainer](scaled, k=k, seed=seed)
    return nearest_center(scaled, centers).select(
        *ATTRIBUTES, *[F.col(f"_raw_{c}").alias(c) for c in FEATURES], "user_cluster"
    )


def cluster_summary(segments: DataFrame) -> DataFrame:
    """Mean of every feature per cluster, to two digits."""
    return segments.groupBy("user_cluster").agg(*[rounded(F.avg(c), 2).alias(c) for c in FEATURES])


def cluster_name(cluster: Column | str, labels: dict[int, str] = CLUSTER_LABELS) -> Column:
    """Presentation name of a cluster id; the id as text if it has none."""
    cluster = F.col(cluster) if isinstance(cluster, str) else cluster
    named = F.coalesce(*[F.when(cluster == i, name) for i, name in labels.items()])
    return F.coalesce(named, cluster.cast("string"))


def rank_clusters(summary: DataFrame) -> DataFrame:
    """Add ``value_rank`` (0 = lowest mean revenue), since cluster ids are arbitrary."""
    # One row per cluster.
    lower = F.array_sort(F.collect_list(F.struct("total_revenue", "user_cluster")))
    order = summary.agg(F.transform(lower, lambda s: s["user_cluster"]).alias("ids")).scalar()
    rank = F.array_position(order, F.col("user_cluster")) - 1
    return summary.withColumn("value_rank", rank.cast("int"))


def segment_rollup(segments: DataFrame) -> DataFrame:
    """Users, event totals, revenue and mean score per cluster."""
    return segments.groupBy("user_cluster").agg(
        F.count("user_id").alias("users"),
        *[
            F.coalesce(F.sum(c), F.lit(0.0)).alias(out)
            for c, out in (
                ("impressions", "impressions"),
                ("clicks", "clicks"),
                ("conversions", "conversions"),
                ("total_revenue", "revenue"),
            )
        ],
        F.avg("avg_ctr_score").alias("avg_ctr_score"),
    )


def users_per_cluster(segments: DataFrame, summary: DataFrame) -> DataFrame:
    """Distinct users of every cluster in the summary, 0 if it has none."""
    users = segments.groupBy("user_cluster").agg(F.countDistinct("user_id").alias("users"))
    return (
        summary.select("user_cluster")
        .join(users, "user_cluster", "left")
        .select("user_cluster", F.coalesce("users", F.lit(0)).alias("users"))
    )


def segment_share(segments: DataFrame, summary: DataFrame) -> DataFrame:
    """Users and percent of all users per named cluster."""
    shared = share_of_total(users_per_cluster(segments, summary), "users", "share_pct", 100.0)
    return shared.withColumn("cluster_name", cluster_name("user_cluster"))


def segment_value(summary: DataFrame) -> DataFrame:
    """Mean revenue, conversions and tenure per named cluster."""
    return summary.select(
        cluster_name("user_cluster").alias("cluster_name"),
        "total_revenue",
        "conversions",
        "days_since_signup",
    )


def segment_engagement(summary: DataFrame) -> DataFrame:
    """Mean impressions and clicks per named cluster, one row per metric."""
    named = summary.select(
        cluster_name("user_cluster").alias("cluster_name"), "impressions", "clicks"
    )
    return named.unpivot("cluster_name", ["impressions", "clicks"], "metric", "value")


def top_clusters(segments: DataFrame, n: int = 3) -> DataFrame:
    """The n clusters with the largest revenue."""
    return top_n(segment_rollup(segments), n, "revenue", "user_cluster")


def segment_region_device(segments: DataFrame, n: int = 3) -> DataFrame:
    """Users per region and device in the n clusters with the largest revenue."""
    counts = (
        segments.filter(F.col("region").isNotNull() & F.col("device").isNotNull())
        .groupBy("user_cluster", "region", "device")
        .agg(F.count("user_id").alias("users"))
    )
    # At most n rows.
    best = F.broadcast(top_clusters(segments, n).select("user_cluster"))
    return counts.join(best, "user_cluster", "left_semi")


def segment_kpis(segments: DataFrame, summary: DataFrame) -> DataFrame:
    """Users, clusters, revenue and mean tenure in one row.

    ``segment_revenue`` adds up the cluster means, as the audience page shows it;
    ``user_revenue`` is the revenue of all users.
    """
    clusters = summary.agg(F.countDistinct("user_cluster").alias("clusters"))
    means = summary.agg(F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("revenue"))
    return segments.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.avg("days_since_signup").alias("avg_days_since_signup"),
        F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("user_revenue"),
    ).select(
        "total_users",
        clusters.scalar().alias("clusters"),
        means.scalar().alias("segment_revenue"),
        "user_revenue",
        "avg_days_since_signup",
    )


def clusters_by_value(segments: DataFrame) -> DataFrame:
    """Clusters by mean revenue per user, highest first."""
    return (
        segments.groupBy("user_cluster")
        .agg(F.avg("total_revenue").alias("avg_revenue_per_user"), F.count("user_id").alias("users"))
        .orderBy(F.desc_nulls_last("avg_revenue_per_user"), "user_cluster")
    )
