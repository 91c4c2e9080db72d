"""Report datasets over the campaign summary, the daily logs and the model scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalars import date_range, day, finite_number, ratio
from adlake.operators.ordered import exact_quantiles, running_total, top_n, total_of

FILTER_COLUMNS = ("target_region", "ad_format", "advertiser")
BAR_COLUMNS = ("impressions_count", "clicks_count", "total_revenue", "budget")
# Quantile steps 0, 0.1, ..., 1 as multiples of the binary step.
DECILES = tuple(i * 0.1 for i in range(10)) + (1.0,)


def _sum(column: str) -> Column:
    """Sum over the readable values, 0 if there are none."""
    return F.coalesce(F.sum(F.col(column).try_cast("double")), F.lit(0.0))


# --- filters -----------------------------------------------------------------


def filter_campaigns(
    summary: DataFrame,
    regions: Sequence[str] = (),
    formats: Sequence[str] = (),
    advertisers: Sequence[str] = (),
) -> DataFrame:
    """Campaigns that match every non-empty list."""
    for column, chosen in zip(FILTER_COLUMNS, (regions, formats, advertisers)):
        if chosen:
            summary = summary.filter(F.col(column).isin(list(chosen)))
    return summary


def filter_values(summary: DataFrame) -> DataFrame:
    """The values each filter offers: sorted rows (filter_name, value)."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in FILTER_COLUMNS])
    )
    return (
        summary.select(pairs.alias("p"))
        .select("p.filter_name", "p.value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter_name", "value")
    )


# --- campaign summary --------------------------------------------------------


def kpi_overview(summary: DataFrame) -> DataFrame:
    """Four totals and six mean measures in one row.

    The measures are means over the campaigns, not ratios of the totals.
    """
    totals = {
        "total_impressions": "impressions_count",
        "total_clicks": "clicks_count",
        "total_revenue": "total_revenue",
        "total_spend": "budget",
    }
    means = {
        "avg_ctr": "ctr",
        "avg_cvr": "cvr",
        "avg_cpc": "cpc",
        "avg_cpm": "cpm",
        "avg_roi": "roi_percentage",
        "avg_roas": "roas",
    }
    return summary.agg(
        *[_sum(c).alias(out) for out, c in totals.items()],
        *[F.coalesce(F.avg(finite_number(c)), F.lit(0.0)).alias(out) for out, c in means.items()],
    )


def advertiser_rollup(summary: DataFrame) -> DataFrame:
    return (
        summary.filter(F.col("advertiser").isNotNull())
        .groupBy("advertiser")
        .agg(
            _sum("total_revenue").alias("revenue"),
            _sum("budget").alias("spend"),
            _sum("impressions_count").alias("impressions"),
        )
    )


def roi_by_region_format(summary: DataFrame) -> DataFrame:
    """Mean ROI per region and format."""
    return (
        summary.filter(F.col("target_region").isNotNull() & F.col("ad_format").isNotNull())
        .groupBy("target_region", "ad_format")
        .agg(F.avg("roi_percentage").alias("roi_percentage"))
    )


def roi_grid(summary: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Mean ROI with one row per region and one column per format.

    Without ``formats`` Spark looks up the distinct formats first.
    """
    return (
        summary.filter(F.col("target_region").isNotNull() & F.col("ad_format").isNotNull())
        .groupBy("target_region")
        .pivot("ad_format", list(formats) if formats else None)
        .agg(F.avg("roi_percentage"))
    )


def roi_quartiles(summary: DataFrame) -> DataFrame:
    """Least, quartiles and greatest ROI per format."""
    probs = {0.0: "low", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "high"}
    rows = exact_quantiles(summary, "roi_percentage", list(probs), by="ad_format")
    return rows.groupBy("ad_format").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in probs.items()]
    )


def roi_vs_ctr(summary: DataFrame) -> DataFrame:
    return summary.select("advertiser", "ad_format", "roi_percentage", "ctr", "budget")


def spend_vs_revenue(summary: DataFrame) -> DataFrame:
    return summary.select("advertiser", "ad_format", "budget", "total_revenue", "impressions_count")


def by_revenue(summary: DataFrame) -> DataFrame:
    """The whole summary, largest revenue first."""
    return summary.orderBy(F.desc_nulls_last("total_revenue"), "campaign_id")


def top_by_revenue(summary: DataFrame, n: int = 30) -> DataFrame:
    return top_n(summary, n, "total_revenue", "campaign_id")


def top_by_roi(summary: DataFrame, n: int = 15) -> DataFrame:
    return top_n(summary, n, "roi_percentage", "campaign_id")


def campaign_bars(summary: DataFrame, n: int = 30) -> DataFrame:
    """The top campaigns by revenue, with four columns also as percent of their maximum.

    The maximum is taken over all campaigns, and is 1 if it is missing or zero.
    """
    maxima = F.struct(*[F.max(F.col(c).cast("double")).alias(c) for c in BAR_COLUMNS])
    largest = total_of(summary, maxima)
    bars = {
        f"{c}_bar": F.col(c).cast("double")
        / F.coalesce(F.nullif(largest[c], F.lit(0.0)), F.lit(1.0))
        * 100
        for c in BAR_COLUMNS
    }
    return top_by_revenue(summary, n).withColumns(bars)


def pareto(summary: DataFrame) -> DataFrame:
    """Revenue per advertiser with the cumulative percent, largest first."""
    revenue = (
        summary.filter(F.col("advertiser").isNotNull())
        .groupBy("advertiser")
        .agg(F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_revenue"))
    )
    ranked = running_total(revenue, [F.desc("total_revenue"), "advertiser"], "total_revenue", "upto")
    total = total_of(ranked, F.sum("total_revenue"))
    return ranked.select(
        "advertiser", "total_revenue", (ratio("upto", total) * 100).alias("cum_pct")
    ).orderBy(F.desc("total_revenue"), "advertiser")


def funnel(summary: DataFrame) -> DataFrame:
    """Impressions, clicks and conversions as rows, with the rate to the stage before
    and to the first stage."""
    sums = summary.agg(
        *[_sum(f"{c}_count").alias(c) for c in ("impressions", "clicks", "conversions")]
    )
    stages = [("impressions", None), ("clicks", "impressions"), ("conversions", "clicks")]
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(stage).alias("stage"),
            F.col(stage).alias("total"),
            (ratio(stage, before) if before else F.lit(None).cast("double")).alias("step_rate"),
            ratio(stage, "impressions").alias("overall_rate"),
        )
        for position, (stage, before) in enumerate(stages, start=1)
    ]
    return sums.select(F.inline(F.array(*rows)))


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return top_n(importance, n, "importance", "feature")


# --- daily series ------------------------------------------------------------


def daily_count(events: DataFrame, out: str) -> DataFrame:
    return events.groupBy(day("timestamp").alias("day")).agg(F.count(F.lit(1)).alias(out))


def daily_revenue(conversions: DataFrame) -> DataFrame:
    revenue = F.coalesce(F.col("revenue").cast("double"), F.lit(0.0))
    return conversions.groupBy(day("timestamp").alias("day")).agg(F.sum(revenue).alias("revenue"))


def daily_spend(campaigns: DataFrame) -> DataFrame:
    """Each budget spread evenly over its days, start and end included, summed per day.

    A campaign that ends before it starts, or lacks a date, has no days.
    """
    days = date_range("start_date", "end_date")
    per_day = F.coalesce(F.col("budget").cast("double"), F.lit(0.0)) / F.size(days)
    return (
        campaigns.filter(F.col("end_date") >= F.col("start_date"))
        .select(per_day.alias("spend"), F.explode(days).alias("day"))
        .groupBy("day")
        .agg(F.sum("spend").alias("spend"))
    )


def between_days(df: DataFrame, start: str | None, end: str | None, column: str) -> DataFrame:
    """Rows whose date lies in the range, both ends included; no bound, no limit.

    Logs stored by ``event_date`` are cut by their folders, so other days are not read.
    """
    if "event_date" in df.columns:
        column = "event_date"
    date = F.col(column) if column in ("event_date", "day") else day(column)
    for bound, inside in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            df = df.filter(inside(date, F.lit(str(bound)).cast("date")))
    return df


def daily_report(
    campaigns: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    conversions: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Spend, impressions, clicks, revenue, cost per click and CTR of every day that has any.

    Events without a time belong to no day. ``start`` and ``end`` bound the days.
    """
    impressions, clicks, conversions = (
        between_days(log, start, end, "timestamp") for log in (impressions, clicks, conversions)
    )
    series = [
        between_days(daily_spend(campaigns), start, end, "day"),
        daily_count(impressions, "impressions"),
        daily_count(clicks, "clicks"),
        daily_revenue(conversions),
    ]
    # One row per day on each side.
    out = series[0]
    for other in series[1:]:
        out = out.join(other.filter(F.col("day").isNotNull()), "day", "full")
    filled = out.na.fill(0, ["spend", "impressions", "clicks", "revenue"])
    return filled.select(
        "day",
        "spend",
        "impressions",
        "clicks",
        "revenue",
        ratio("spend", "clicks").alias("cpc"),
        ratio("clicks", "impressions").alias("ctr"),
    ).orderBy("day")


def ctr_percent(daily: DataFrame) -> DataFrame:
    return daily.select("day", (F.col("ctr") * 100).alias("ctr_pct"))


def revenue_spend_trend(daily: DataFrame) -> DataFrame:
    return daily.select("day", "revenue", "spend").orderBy("day")


# --- model scores ------------------------------------------------------------


def score_by_format_region(predictions: DataFrame) -> DataFrame:
    """Mean predicted click probability per format and region."""
    return (
        predictions.filter(F.col("ad_format").isNotNull() & F.col("target_region").isNotNull())
        .groupBy("ad_format", "target_region")
        .agg(F.avg("predicted_prob").alias("predicted_prob"))
    )


def score_hierarchy(predictions: DataFrame) -> DataFrame:
    """The means as a tree: leaves, one node per format, and the root.

    ``size`` adds up the leaf means; ``shade`` is their mean weighted by themselves,
    which is how a treemap colours a parent.
    """
    p = F.col("predicted_prob")
    return (
        score_by_format_region(predictions)
        .rollup("ad_format", "target_region")
        .agg(
            F.grouping_id().alias("_level"),
            F.sum(p).alias("size"),
            ratio(F.sum(p * p), F.sum(p)).alias("shade"),
        )
        .select(
            F.when(F.col("_level") == 0, "leaf")
            .when(F.col("_level") == 1, "format")
            .otherwise("total")
            .alias("node"),
            "ad_format",
            "target_region",
            "size",
            "shade",
        )
    )


def score_histogram(predictions: DataFrame, bins: int = 40, by: str | None = None) -> DataFrame:
    """Rows per equal-width bin of the score on [0, 1]; the last bin includes 1."""
    number = F.least(F.floor(F.col("predicted_prob") * bins), F.lit(bins - 1)).cast("int")
    keys = [F.col(by)] if by else []
    return (
        predictions.filter(F.col("predicted_prob").isNotNull())
        .groupBy(*keys, number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("volume"))
        .withColumn("lower_edge", F.col("bin") / bins)
    )


def calibration(predictions: DataFrame) -> DataFrame:
    """Mean score, actual click rate and volume per score decile.

    The edges are interpolated deciles, each bin includes its upper edge, and equal
    edges are merged, so there may be fewer than ten bins.
    """
    scored = predictions.filter(F.col("predicted_prob").isNotNull())
    # Eleven rows.
    edges = (
        exact_quantiles(scored, "predicted_prob", DECILES)
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))
        .scalar()
    )
    rows = scored.withColumn("_edges", edges).filter(F.size("_edges") >= 2)
    inner = F.slice("_edges", F.lit(2), F.size("_edges") - 2)
    passed = F.size(F.filter(inner, lambda edge: edge < F.col("predicted_prob")))
    return (
        rows.groupBy((passed + 1).alias("decile"))
        .agg(
            F.avg("predicted_prob").alias("predicted"),
            F.avg(F.col("actual_clicked").cast("double")).alias("actual"),
            F.count("predicted_prob").alias("volume"),
        )
        .orderBy("decile")
    )
