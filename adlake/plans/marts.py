"""Campaign performance and the campaign summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions import kpi


def events_per_campaign(events: DataFrame, out: str) -> DataFrame:
    return events.groupBy("campaign_id").agg(F.count(F.lit(1)).alias(out))


def conversions_per_campaign(conversions: DataFrame) -> DataFrame:
    """Count and revenue; a campaign whose revenues are all missing has revenue 0."""
    return conversions.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("conversions_count"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
    )


def campaign_performance(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Event counts and revenue per campaign; null where a campaign has no events.

    Each log is counted per campaign before it meets the campaigns, so the joins see
    one row per campaign on both sides whatever the size of the logs.
    """
    facts = [
        events_per_campaign(staged["impressions"], "impressions_count"),
        events_per_campaign(staged["clicks"], "clicks_count"),
        conversions_per_campaign(staged["conversions"]),
    ]
    return with_facts(staged["campaigns"], facts)


def with_facts(campaigns: DataFrame, facts: Sequence[DataFrame]) -> DataFrame:
    """Every campaign with its row of each fact, if there is one."""
    out = campaigns.select("campaign_id")
    for fact in facts:
        out = out.join(fact, "campaign_id", "left")
    return out


def campaign_summary(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Campaign attributes, counts and all performance measures."""
    return summarized(campaign_performance(staged), staged["campaigns"])


def summarized(performance: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The campaign summary from the counts and revenue of each campaign."""
    joined = performance.join(campaigns, "campaign_id")
    days = kpi.active_days("end_date", "start_date")
    return joined.select(
        "campaign_id",
        "advertiser",
        "target_region",
        "ad_format",
        "impressions_count",
        "clicks_count",
        "conversions_count",
        "total_revenue",
        "budget",
        kpi.click_through_rate("clicks_count", "impressions_count").alias("ctr"),
        kpi.conversion_rate("conversions_count", "clicks_count").alias("cvr"),
        kpi.roi_percentage("total_revenue", "budget").alias("roi_percentage"),
        kpi.cost_per("budget", "clicks_count").alias("cpc"),
        kpi.cost_per("budget", "conversions_count").alias("cpa"),
        kpi.cost_per_thousand("budget", "impressions_count").alias("cpm"),
        kpi.revenue_per("total_revenue", "clicks_count").alias("rpc"),
        kpi.revenue_per("total_revenue", "conversions_count").alias("rpcv"),
        kpi.return_on_ad_spend("total_revenue", "budget").alias("roas"),
        days.alias("active_days"),
        kpi.revenue_per("total_revenue", days).alias("revenue_per_day"),
    )
