"""Staging: final types, presentation case and required keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalars import capitalize_words, money
from adlake.sources.tables import LazyTables

_CASTS: dict[str, Callable[[str], Column]] = {
    "title": capitalize_words,
    "lower": F.lower,
    "money": money,
    "text": F.col,
}

# Per entity: the keys a row needs, and the columns with their presentation or type.
STAGED = {
    "users": (
        ("user_id",),
        {
            "user_id": "int",
            "region": "title",
            "device": "title",
            "subscription_tier": "title",
            "signup_date": "date",
        },
    ),
    "campaigns": (
        ("campaign_id",),
        {
            "campaign_id": "int",
            "advertiser": "text",
            "budget": "money",
            "target_region": "title",
            "ad_format": "lower",
            "start_date": "date",
            "end_date": "date",
        },
    ),
}
for _entity, _columns in {
    "impressions": {"device": "lower", "ad_slot": "lower", "ad_format": "lower"},
    "clicks": {"click_position": "int"},
    "conversions": {"product_category": "text", "revenue": "money"},
}.items():
    STAGED[_entity] = (
        ("user_id", "campaign_id"),
        {
            f"{_entity.removesuffix('s')}_id": "bigint",
            "user_id": "int",
            "campaign_id": "int",
            "timestamp": "timestamp",
            **_columns,
        },
    )


def stage(rows: DataFrame, entity: str) -> DataFrame:
    """Rows of a cleaned entity that have their keys, in their final types."""
    keys, columns = STAGED[entity]
    shown = [
        (_CASTS[kind](name) if kind in _CASTS else F.col(name).cast(kind)).alias(name)
        for name, kind in columns.items()
    ]
    return rows.dropna(subset=list(keys)).select(*shown)


def stage_all(silver: Mapping[str, DataFrame]) -> LazyTables:
    """Staged tables under their entity names."""

    def make(name: str) -> DataFrame:
        return stage(silver[name], name)

    return LazyTables({name: partial(make, name) for name in STAGED if name in silver})
