"""The five entities derived from the sample tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.sources.schemas import ENTITIES, ENTITY_SPECS
from adlake.sources.tables import LazyTables

FORMATS = ("banner", "video", "carousel")

# Columns of the sample tables that are read.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "part": "p_partkey long, p_brand string, p_size int, p_retailprice double",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
}

_DEVICE = "array('mobile', 'desktop', 'tablet')[int({key} % 3)]"
_FORMAT = "array('banner', 'video', 'carousel')[int({key} % 3)]"

# Event ids lie above the range of 32-bit integers. Some optional values are missing.
_EVENT_ID = "event_id + 3000000000"
_MAYBE = "if(event_id % {n} = 0, null, {value})"
_SLOT = "array('top', 'side', 'feed')[int(event_id % 3)]"
_OPTIONAL = (
    _MAYBE.format(n=4, value=_DEVICE.format(key="user_id")) + " as device",
    _MAYBE.format(n=5, value=_SLOT) + " as ad_slot",
    _MAYBE.format(n=6, value=_FORMAT.format(key="campaign_id")) + " as ad_format",
)
_EVENT_COLUMNS = {
    "impressions": (
        f"{_EVENT_ID} as impression_id",
        "int(user_id) as user_id",
        "campaign_id",
        "timestamp",
        _DEVICE.format(key="user_id") + " as device",
        f"{_SLOT} as ad_slot",
        _FORMAT.format(key="campaign_id") + " as ad_format",
    ),
    "clicks": (
        f"{_EVENT_ID} as click_id",
        _MAYBE.format(n=3, value="event_id * 7 + 3000000000") + " as impression_id",
        "int(user_id) as user_id",
        "campaign_id",
        "timestamp",
        "int(event_id % 5 + 1) as click_position",
        *_OPTIONAL,
    ),
    "conversions": (
        f"{_EVENT_ID} as conversion_id",
        _MAYBE.format(n=3, value="event_id * 5 + 3000000000") + " as click_id",
        "int(user_id) as user_id",
        "campaign_id",
        _MAYBE.format(n=7, value="concat('A-', event_id)") + " as order_id",
        "array('games', 'toys', 'food', 'books')[int(event_id % 4)] as product_category",
        "value as revenue",
        _MAYBE.format(n=8, value="event_id * 7 + 3000000000") + " as impression_id",
        "timestamp",
        *_OPTIONAL,
        _MAYBE.format(n=9, value="int(event_id % 5 + 1)") + " as click_position",
    ),
}
EVENT_TYPES = {"impressions": "view", "clicks": "click", "conversions": "purchase"}


def read_sample(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream."""
    reader = spark.readStream.schema(_COLUMNS["events"])
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def sample_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_sample(spark, sf_dir, "part")
    region = read_sample(spark, sf_dir, "region")
    # Five regions at any scale. One campaign in forty ends the day before it starts.
    named = part.join(F.broadcast(region), F.expr("r_regionkey = p_partkey % 5"))
    return named.selectExpr(
        "int(p_partkey) as campaign_id",
        "lower(p_brand) as advertiser",
        "p_retailprice as budget",
        "lower(r_name) as target_region",
        _FORMAT.format(key="p_partkey") + " as ad_format",
        "date_add(date '2024-01-01', p_size % 10) as start_date",
        "date_add(date '2024-01-01', p_size % 10 + if(p_partkey % 40 = 39, -1, p_size % 30))"
        " as end_date",
    )


def sample_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_sample(spark, sf_dir, "customer")
    nation = read_sample(spark, sf_dir, "nation")
    region = read_sample(spark, sf_dir, "region")
    # Twenty-five nations at any scale.
    places = nation.join(F.broadcast(region), F.expr("n_regionkey = r_regionkey"))
    named = customer.join(F.broadcast(places), F.expr("c_nationkey = n_nationkey"))
    return named.selectExpr(
        "int(c_custkey) as user_id",
        "lower(r_name) as region",
        _DEVICE.format(key="c_custkey") + " as device",
        "case when c_acctbal < 0 then 'basic' when c_acctbal < 5000 then 'standard'"
        " else 'premium' end as subscription_tier",
        "date_sub(date '2023-12-31', int(c_custkey % 365)) as signup_date",
    )


def shape_events(events: DataFrame, entity: str) -> DataFrame:
    """One kind of event as the columns of its entity (batch or stream)."""
    return (
        events.filter(F.col("event_type") == EVENT_TYPES[entity])
        .selectExpr(
            "event_id",
            "user_id",
            "try_cast(regexp_extract(props, '([0-9]+)', 1) as int) as campaign_id",
            "cast(ts as timestamp) as timestamp",
            "value",
        )
        .selectExpr(*_EVENT_COLUMNS[entity])
    )


def sample_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    if entity == "users":
        return sample_users(spark, sf_dir)
    if entity == "campaigns":
        return sample_campaigns(spark, sf_dir)
    return shape_events(read_sample(spark, sf_dir, "events"), entity)


def silver_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The typed entities, as the silver layer would hold them."""
    return LazyTables({e: partial(sample_entity, spark, sf_dir, e) for e in ENTITIES})


def bronze_records(
    spark: SparkSession, sf_dir: str, entity: str, with_copy: bool = False
) -> DataFrame:
    """The entity as raw JSON records with the faults a feed shows.

    By the first key column k: text padded and upper-cased (k % 7 = 0), a bad date
    or number (k % 11 = 0), a whole number written as decimal (k % 13 = 0), the
    record cut off (k % 97 = 0), and sent twice (k % 50 = 0; ``with_copy`` numbers them).
    """
    rows = sample_entity(spark, sf_dir, entity)
    key = F.col(ENTITY_SPECS[entity][0][0])
    kinds = dict(ENTITY_SPECS[entity])
    broken = {"users": "signup_date", "campaigns": "budget", "conversions": "revenue"}.get(
        entity, "timestamp"
    )
    columns = []
    for name in rows.columns:
        value = F.col(name).cast("string")
        if kinds[name] in ("lower", "text"):
            padded = F.concat(F.lit("  "), F.upper(value), F.lit(" "))
            value = F.when(key % 7 == 0, padded).otherwise(value)
        elif name == broken:
            value = F.when(key % 11 == 0, F.lit("n/a")).otherwise(value)
        elif kinds[name] in ("int", "long"):
            value = F.when(key % 13 == 0, F.concat(value, F.lit(".0"))).otherwise(value)
        columns.append(value.alias(name))
    copies = F.when(key % 50 == 0, 2).otherwise(1)
    record = F.to_json(F.struct(*columns))
    cut = F.when(key % 97 == 0, F.substring(record, 1, 12)).otherwise(record)
    records = rows.select(
        cut.alias("json_record"), F.explode(F.sequence(F.lit(1), copies)).alias("copy")
    )
    return records if with_copy else records.drop("copy")
