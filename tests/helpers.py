"""Small entities with the cases the jobs must survive, and comparison helpers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from adlake.plans.staging import stage_all
from adlake.sources.schemas import silver_schema

AD_FORMATS = ("banner", "video")


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


def by_key(df: DataFrame, *keys: str) -> dict:
    out = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        out[key[0] if len(keys) == 1 else key] = r
    return out


def _at(minutes: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def small_silver() -> dict[str, list[tuple]]:
    """Repeated ids, users and campaigns without events, nulls and a dominant user."""
    users = [
        (1, "us", "mobile", "basic", date(2023, 12, 1)),
        (2, "eu", "desktop", "premium", date(2023, 11, 1)),
        (3, "apac", "tablet", "basic", None),
        (4, None, "mobile", "basic", date(2024, 1, 1)),
        (5, "us", "mobile", "standard", date(2023, 10, 1)),
        (None, "us", "mobile", "basic", date(2023, 12, 1)),
    ]
    campaigns = [
        (10, "acme", 100.0, "us", "banner", date(2024, 1, 1), date(2024, 1, 3)),
        (11, "acme", 0.0, "eu", "video", date(2024, 1, 2), date(2024, 1, 2)),
        (12, "zeta", 50.0, "apac", "video", date(2024, 1, 5), date(2024, 1, 4)),
        (13, None, None, "us", "banner", None, date(2024, 1, 4)),
        (14, "zeta", 70.0, None, "banner", date(2024, 1, 1), date(2024, 1, 1)),
        (None, "none", 1.0, "us", "banner", date(2024, 1, 1), date(2024, 1, 1)),
    ]
    impressions = [
        (i, 1, 10 + i % 3, _at(i * 97), "mobile", "top", AD_FORMATS[i % 2]) for i in range(40)
    ]
    impressions += [
        (100, 2, 10, _at(5), "desktop", "feed", "banner"),
        (100, 2, 11, _at(6), "desktop", "feed", "video"),  # same id on two campaigns
        (100, 2, 11, _at(6), "desktop", "feed", "video"),  # copy
        (101, 2, 14, _at(7), "desktop", "side", "banner"),
        (102, 3, 12, None, "tablet", "top", "video"),
        (103, 4, 10, _at(9), "mobile", "top", "banner"),
        (104, 9, 10, _at(9), "mobile", "top", "banner"),  # unknown user
        (105, None, 10, _at(9), "mobile", "top", "banner"),
        (106, 1, None, _at(9), "mobile", "top", "banner"),
    ]
    clicks = [(i, None, 1, 10 + i % 2, _at(i * 150), i % 4, None, None, None) for i in range(12)]
    clicks += [
        (50, None, 2, 11, _at(6), 1, None, None, None),
        (50, None, 2, 10, _at(20), 1, None, None, None),  # same id twice
        (51, None, 3, 11, _at(8), 2, None, None, None),  # campaign not seen
        (52, None, None, 10, _at(8), 2, None, None, None),
    ]
    empty = (None,) * 5
    conversions = [
        (1, None, 1, 10, "A-1", "games", 10.25, None, _at(200), *empty[:4]),
        (2, None, 1, 10, "A-2", "toys", None, None, _at(2000), *empty[:4]),
        (2, None, 1, 12, "A-2", "toys", 5.5, None, _at(2100), *empty[:4]),
        (3, None, 2, 11, "A-3", "food", 7.0, None, None, *empty[:4]),
        (4, None, 5, 13, "A-4", "food", None, None, _at(10), *empty[:4]),
        (5, None, None, 10, "A-5", "food", 3.0, None, _at(10), *empty[:4]),
    ]
    return {
        "users": users,
        "campaigns": campaigns,
        "impressions": impressions,
        "clicks": clicks,
        "conversions": conversions,
    }


def silver_frames(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        name: spark.createDataFrame(data, silver_schema(name))
        for name, data in small_silver().items()
    }


def staged_frames(spark: SparkSession):
    return stage_all(silver_frames(spark))
