"""Click-model training set and per-user features."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalars import day_of_week, days_between, peak_hour_flag, ratio
from adlake.operators.ordered import running_totals_by
from adlake.session import materialize

PAIR = ["user_id", "campaign_id"]


def first_click(clicks: DataFrame) -> DataFrame:
    """Time of the first click of each user on each campaign."""
    return clicks.groupBy(*PAIR).agg(F.min("timestamp").alias("first_click_time"))


def clicked_impressions(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Impressions of campaigns that the same user also clicked: (pair, impression_id).

    Both sides may be logs; adaptive execution broadcasts the pairs if their shuffle
    turned out small, and splits the partitions of hot pairs otherwise.
    """
    return impressions.select(*PAIR, "impression_id").join(
        clicks.select(*PAIR).distinct(), PAIR, "left_semi"
    )


def _click_rate(matched: DataFrame) -> DataFrame:
    """Campaigns are counted on the distinct pairs, so that the log is not expanded."""
    campaigns = (
        matched.select(*PAIR)
        .distinct()
        .groupBy("user_id")
        .agg(F.count("campaign_id").alias("campaigns"))
    )
    seen = matched.groupBy("user_id").agg(F.countDistinct("impression_id").alias("impressions"))
    return campaigns.join(seen, "user_id").select(
        "user_id", ratio("campaigns", "impressions").alias("user_click_rate")
    )


def user_click_rate(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Per user: campaigns both seen and clicked / distinct impressions of those campaigns.

    Only distinct counts are taken, so the clicked impressions replace the
    many-to-many join of the two logs.
    """
    return _click_rate(clicked_impressions(impressions, clicks))


def _ctr_history(log: DataFrame, seen_pairs: DataFrame, clicks: DataFrame) -> DataFrame:
    seen = log.groupBy("campaign_id").agg(F.countDistinct("impression_id").alias("impressions"))
    # Pairs that were both seen and clicked: no more of them than clicks.
    clicked = (
        clicks.select(*PAIR, "click_id")
        .join(seen_pairs, PAIR, "left_semi")
        .groupBy("campaign_id")
        .agg(F.countDistinct("click_id").alias("clicks"))
    )
    return seen.join(clicked, "campaign_id", "left").select(
        "campaign_id",
        ratio(F.coalesce("clicks", F.lit(0)), "impressions").alias("campaign_ctr_history"),
    )


def campaign_ctr_history(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Per campaign: distinct clicks by users who saw it / distinct impressions."""
    return _ctr_history(impressions, impressions.select(*PAIR).distinct(), clicks)


def click_label(first_click_time: Column, impression_time: Column) -> Column:
    """1 if the user's first click on the campaign came at or after the impression.

    Impressions after that first click count as not clicked, even if another click
    follows them.
    """
    hit = first_click_time.isNotNull() & (first_click_time >= impression_time)
    return F.when(hit, 1).otherwise(0)


def _dimensions(staged: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Users and campaigns whose attributes the click model needs and are known."""
    users = staged["users"].select("user_id", "region", "device", "subscription_tier")
    campaigns = staged["campaigns"].select("campaign_id", "ad_format", "target_region", "budget")
    return (
        users.filter(F.col("region").isNotNull() & F.col("device").isNotNull()),
        campaigns.filter(F.col("ad_format").isNotNull() & F.col("target_region").isNotNull()),
    )


def _click_log(staged: Mapping[str, DataFrame]) -> DataFrame:
    """The impressions with the first click of their pair, stored narrow: the log is read once."""
    return materialize(
        staged["impressions"]
        .select("impression_id", *PAIR, F.col("timestamp").alias("impression_time"))
        .join(first_click(staged["clicks"]).withColumn("_paired", F.lit(True)), PAIR, "left"),
        "log",
    )


def _training_rows(base: DataFrame) -> DataFrame:
    time = F.col("impression_time")
    return base.select(
        "impression_id",
        "user_id",
        "campaign_id",
        "region",
        "device",
        "subscription_tier",
        "ad_format",
        "target_region",
        "budget",
        F.hour(time).alias("hour_of_day"),
        day_of_week(time).alias("day_of_week"),
        peak_hour_flag(time).alias("is_peak_hour"),
        F.coalesce("user_click_rate", F.lit(0.0)).alias("user_click_rate"),
        F.coalesce("campaign_ctr_history", F.lit(0.0)).alias("campaign_ctr_history"),
        click_label(F.col("first_click_time"), time).alias("clicked"),
    )


def training_set(staged: Mapping[str, DataFrame]) -> DataFrame:
    """One row per impression with user, campaign and history features and the label.

    The impression log is read once: joined with the clicked pairs and stored narrow, as
    the rates, the history and the rows all need it. What is known per user (or per
    campaign) is combined first, so that the log is joined once per key. The history
    features use the whole log, including the labelled events; ``training_set_as_of``
    uses only what was known before each impression.
    """
    users, campaigns = _dimensions(staged)
    log = _click_log(staged)
    matched = log.filter("_paired")
    rates = _click_rate(matched)
    history = _ctr_history(log, matched.select(*PAIR).distinct(), staged["clicks"])
    per_user = users.join(rates, "user_id", "left")
    per_campaign = campaigns.join(history, "campaign_id", "left")
    return _training_rows(log.join(per_user, "user_id").join(per_campaign, "campaign_id"))


def _counted_before(rows: DataFrame, key: str, events: Mapping[str, DataFrame]) -> DataFrame:
    """Add to ``rows`` (with impression_time) how many events of their key came before.

    ``events`` maps a new column to a frame (key, at), one row for each thing that counts,
    at the time from which it does. Rows and events are put on one time axis per key, the
    rows ahead of the events of the same moment, and the events are summed along it.
    """
    kept = [c for c in rows.columns if c != key]
    axis = rows.select(
        key, F.col("impression_time").alias("at"), F.lit(0).alias("event"), F.struct(*kept).alias("row"),
        *[F.lit(0).cast("long").alias(c) for c in events],
    )
    shape = axis.schema["row"].dataType
    for name, frame in events.items():
        # Summed per moment first: copies of a moment are one row.
        steps = frame.groupBy(key, "at").agg(F.count(F.lit(1)).alias("n"))
        axis = axis.union(
            steps.select(
                key, "at", F.lit(1), F.lit(None).cast(shape),
                *[(F.col("n") if c == name else F.lit(0).cast("long")).alias(c) for c in events],
            )
        )
    summed = running_totals_by(axis, key, ["at", "event"], {f"_{c}": c for c in events})
    return summed.filter("event = 0").select(
        key, "row.*", *[F.col(f"_{c}").alias(c) for c in events]
    )


def history_as_of(log: DataFrame, clicks: DataFrame) -> DataFrame:
    """Add both history features as they stood before each impression of ``log``.

    ``log`` holds impression_id, the pair, impression_time and first_click_time, the first
    click of the pair. Something counts from the moment on at which all of it is known:

    - a campaign of a user from its first view or first click by the user, the later one;
    - an impression of a user from its own time or that first click, the later one;
    - an impression of a campaign from its own time;
    - a click of a campaign from its own time or the user's first view, the later one.

    Repeated ids count once per user or campaign, from the earliest such moment. Events at
    the very time of an impression are not before it. Events without a time never count,
    and impressions without one have no history. Nothing is joined by time.
    """
    known = log.filter(F.col("impression_time").isNotNull())
    paired = known.filter(F.col("first_click_time").isNotNull())
    both = F.greatest("impression_time", "first_click_time")
    per_user = {
        "campaigns": paired.groupBy(*PAIR).agg(F.min(both).alias("at")),
        "impressions": paired.groupBy("user_id", "impression_id").agg(F.min(both).alias("at")),
    }
    views = known.groupBy(*PAIR).agg(F.min("impression_time").alias("first_view"))
    seen_clicks = (
        clicks.filter(F.col("timestamp").isNotNull())
        .select("click_id", "timestamp", *PAIR)
        .join(views, PAIR)
        .groupBy("campaign_id", "click_id")
        .agg(F.min(F.greatest("timestamp", "first_view")).alias("at"))
    )
    per_campaign = {
        "clicks": seen_clicks,
        "shown": known.groupBy("campaign_id", "impression_id").agg(F.min("impression_time").alias("at")),
    }
    rows = _counted_before(known, "user_id", per_user)
    rate = ratio("campaigns", "impressions").alias("user_click_rate")
    rows = rows.select(*known.columns, rate)
    rows = _counted_before(rows, "campaign_id", per_campaign)
    history = ratio("clicks", "shown").alias("campaign_ctr_history")
    timeless = log.filter(F.col("impression_time").isNull())
    nothing = [F.lit(None).cast("double").alias(c) for c in ("user_click_rate", "campaign_ctr_history")]
    return rows.select(*known.columns, "user_click_rate", history).union(timeless.select("*", *nothing))


def training_set_as_of(staged: Mapping[str, DataFrame]) -> DataFrame:
    """``training_set`` with the history features as they stood before each impression.

    No feature of a row knows its label or anything else that came at or after it.
    """
    users, campaigns = _dimensions(staged)
    rows = history_as_of(_click_log(staged), staged["clicks"])
    return _training_rows(rows.join(users, "user_id").join(campaigns, "campaign_id"))


def _per_user(events: DataFrame, key: str, out: str, *extra: Column) -> DataFrame:
    return events.groupBy("user_id").agg(
        F.countDistinct(key).alias(out), F.count(F.lit(1)).alias(f"_{out}_rows"), *extra
    )


def user_engagement(staged: Mapping[str, DataFrame], compat: bool = False) -> DataFrame:
    """Distinct impressions, clicks and conversions and the revenue of every user.

    ``compat`` gives the revenue of the plain three-way join of the logs on user,
    where each conversion repeats once per impression and click of the user: the
    sum is multiplied by those row counts instead of building the rows.
    """
    users = staged["users"].groupBy("user_id").agg(F.count(F.lit(1)).alias("_user_rows"))
    out = (
        users.join(_per_user(staged["impressions"], "impression_id", "impressions"), "user_id", "left")
        .join(_per_user(staged["clicks"], "click_id", "clicks"), "user_id", "left")
        .join(
            _per_user(
                staged["conversions"],
                "conversion_id",
                "conversions",
                F.sum("revenue").alias("_revenue"),
            ),
            "user_id",
            "left",
        )
    )
    revenue = F.coalesce("_revenue", F.lit(0).cast("decimal(38,6)"))
    if compat:
        # Wide decimals, as the product of the row counts can exceed a long.
        for rows in ("_user_rows", "_impressions_rows", "_clicks_rows"):
            repeats = F.greatest(F.coalesce(rows, F.lit(0)), F.lit(1)).cast("decimal(20,0)")
            revenue = revenue * repeats
    return out.select(
        "user_id",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("impressions", "clicks", "conversions")
        ],
        revenue.alias("total_revenue"),
    )


def user_scores(
    staged: Mapping[str, DataFrame], predictions: DataFrame, compat: bool = False
) -> DataFrame:
    """Mean predicted click probability per user, over the kinds of ads they saw.

    A kind is (ad format, device, region). By default region is the campaign's
    target and device the user's. ``compat`` compares the stored keys as they are:
    the impression's device in lower case and its ad slot against the region.
    """
    scores = predictions.groupBy("ad_format", "device", "target_region").agg(
        F.sum("predicted_prob").alias("_score_sum"),
        F.count("predicted_prob").alias("_score_rows"),
    )
    kind = ["ad_format", "device", "target_region"]
    impressions = staged["impressions"]
    rows = F.count(F.lit(1)).alias("_seen")
    if compat:
        seen = impressions.groupBy(
            "user_id", "ad_format", "device", F.col("ad_slot").alias("target_region")
        ).agg(rows)
    else:
        campaigns = staged["campaigns"].select("campaign_id", "target_region")
        per_pair = impressions.groupBy(*PAIR, "ad_format").agg(rows)
        seen = (
            per_pair.join(campaigns, "campaign_id")
            .groupBy("user_id", "ad_format", "target_region")
            .agg(F.sum("_seen").alias("_seen"))
            .join(staged["users"].select("user_id", "device"), "user_id")
        )
    return (
        seen.join(scores, kind)
        .groupBy("user_id")
        .agg(
            F.sum(F.col("_seen") * F.col("_score_sum")).alias("_sum"),
            F.sum(F.col("_seen") * F.col("_score_rows")).alias("_rows"),
        )
        .select("user_id", ratio("_sum", "_rows").alias("avg_ctr_score"))
    )


def user_features(
    staged: Mapping[str, DataFrame],
    predictions: DataFrame,
    as_of: date | str | Column,
    compat: bool = False,
) -> DataFrame:
    """Engagement, mean score, attributes and tenure of every user at the day ``as_of``."""
    if not isinstance(as_of, Column):
        as_of = F.lit(str(as_of)).cast("date")
    return (
        user_engagement(staged, compat)
        .join(staged["users"], "user_id")
        .join(user_scores(staged, predictions, compat), "user_id", "left")
        .select(
            "user_id",
            "impressions",
            "clicks",
            "conversions",
            "total_revenue",
            F.coalesce("avg_ctr_score", F.lit(0.0)).alias("avg_ctr_score"),
            "region",
            "device",
            "subscription_tier",
            days_between(as_of, "signup_date").alias("days_since_signup"),
        )
    )
