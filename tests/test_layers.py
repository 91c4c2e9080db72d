"""Sources, silver and staging."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adlake.plans import examples
from adlake.plans.pipeline import build_silver, read_silver
from adlake.plans.silver import (
    clean_and_rejected,
    count_rejected,
    repair_money,
    silver,
    trim_text_columns,
    unparsed_values,
)
from adlake.plans.staging import stage_all
from adlake.sources import landing, schemas, tables, testdata
from helpers import rows, silver_frames, staged_frames

SF = "/root/testdata/sf0.001"


def bronze(spark, *records):
    return spark.createDataFrame([(r,) for r in records], "json_record string")


CLICK = (
    '{"click_id": "7", "impression_id": "3", "user_id": " 1 ", "campaign_id": "2.0", '
    '"timestamp": "2024-01-02 03:04:05", "click_position": "x", "device": "  MOBILE ", "extra": "1"}'
)


@pytest.mark.parametrize("as_map", [False, True])
def test_silver_types_and_faults(spark, as_map):
    got = silver(
        bronze(
            spark,
            CLICK,
            CLICK,
            '{"click_id": "8", "user_id": 5, "timestamp": "not a time", "ad_slot": null}',
            '{"click_id": "9", ',
            "garbage",
            None,
        ),
        "clicks",
        as_map=as_map,
    )
    assert got.schema == schemas.silver_schema("clicks")
    assert rows(got) == sorted(
        [
            (7, 3, 1, 2, datetime(2024, 1, 2, 3, 4, 5), None, "mobile", None, None),
            (8, None, 5, None, None, None, None, None, None),
            (None,) * 9,  # all unreadable records are one row after deduplication
        ],
        key=lambda r: tuple(map(str, r)),
    )


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_clean_and_rejected_in_one_pass(spark, tmp_path, entity):
    """The rows of ``silver``, the counts of ``unparsed_values``, and bronze read by one job."""
    path = str(tmp_path / "bronze")
    testdata.bronze_records(spark, SF, entity).write.parquet(path)
    records = spark.read.parquet(path)
    typed, rejected = clean_and_rejected(records, entity)
    assert not [f for df in (typed, rejected) for f in df.inputFiles() if path in f]
    assert rows(typed) == rows(silver(records, entity)) and typed.schema == silver(records, entity).schema
    assert rows(count_rejected(rejected, entity)) == rows(unparsed_values(records, entity))


def test_rejected_values_come_with_their_records(spark):
    late = '{"click_id": "8", "user_id": "x", "timestamp": "not a time", "click_position": " "}'
    records = bronze(spark, CLICK, late, '{"click_id": "9", ', "garbage", None, "[1]", '{"click_id": null}')
    typed, rejected = clean_and_rejected(records, "clicks")
    assert rows(rejected) == sorted(
        [
            (CLICK, "click_position", "x", "no int"),
            (late, "user_id", "x", "no int"),
            (late, "timestamp", "not a time", "no timestamp"),
            (late, "click_position", " ", "no int"),
            ('{"click_id": "9", ', "json_record", None, "no JSON object"),
            ("garbage", "json_record", None, "no JSON object"),
            (None, "json_record", None, "no JSON object"),
        ],
        key=lambda r: tuple(map(str, r)),
    )
    assert rows(typed) == rows(silver(records, "clicks"))
    assert clean_and_rejected(records.limit(0), "clicks")[1].count() == 0


def test_silver_keeps_case_of_order_id(spark):
    got = silver(bronze(spark, '{"order_id": " Ab-C ", "product_category": " Toys", "revenue": "-2.5"}'), "conversions")
    row = got.first()
    assert (row["order_id"], row["product_category"], row["revenue"]) == ("Ab-C", "toys", -2.5)


def test_negative_money_is_nulled_on_request(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "budget double")
    assert [r[0] for r in repair_money(df, "campaigns").collect()] == [-1.0, 2.0, None]
    assert [r[0] for r in repair_money(df, "campaigns", True).collect()] == [None, 2.0, None]


def test_trim_text_columns(spark):
    df = spark.createDataFrame([(" a ", 1)], "s string, n int")
    assert trim_text_columns(df).first()[:] == ("a", 1)


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_map_and_struct_parsing_agree(spark, entity):
    records = testdata.bronze_records(spark, SF, entity)
    assert rows(silver(records, entity)) == rows(silver(records, entity, as_map=True))


def test_csv_to_silver(spark, tmp_path):
    path = tmp_path / "campaigns.csv"
    path.write_text(
        "campaign_id,advertiser,target_region,ad_format,start_date,end_date,budget,total_rev\n"
        '1,"Morris, Shaw and ""Co""",EU,Banner,2024-07-04,2024-09-08,17365,22327\n'
        "2,Young Inc,,video,2024-07-01,,7781.5,453\n"
    )
    csv = landing.read_csv(spark, str(path))
    assert {f.dataType.simpleString() for f in csv.schema.fields} == {"string"}
    topic = str(tmp_path / "topic")
    landing.write_messages(landing.as_messages(csv), topic, "text")
    records = landing.to_bronze(landing.read_messages(spark, topic, "text"))
    assert rows(silver(records, "campaigns")) == [
        (1, 'morris, shaw and "co"', 17365.0, "eu", "banner", date(2024, 7, 4), date(2024, 9, 8)),
        (2, "young inc", 7781.5, "", "video", date(2024, 7, 1), None),
    ]


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,name\n1,"two\nlines"\n')
    assert rows(landing.read_csv(spark, str(path), multi_line=True)) == [("1", "two\nlines")]


def test_bronze_from_message_bytes(spark):
    df = spark.createDataFrame([(bytearray(b'{"a": 1}'), "users")], "value binary, topic string")
    assert rows(landing.to_bronze(df)) == [('{"a": 1}',)]


def test_layers_round_trip(spark, tmp_path):
    root = str(tmp_path)
    for entity in schemas.ENTITIES:
        tables.write_layer(testdata.bronze_records(spark, SF, entity), root, "bronze", entity)
    build_silver(spark, root)
    stored = read_silver(spark, root)
    for entity in schemas.ENTITIES:
        assert rows(stored[entity].drop("event_date")) == rows(silver(testdata.bronze_records(spark, SF, entity), entity))


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "clicks")
    clicks = testdata.silver_tables(spark, SF)["clicks"].withColumn("event_date", F.to_date("timestamp"))
    tables.write_parquet(clicks, path, "event_date")
    back = tables.load_table(spark, path, "parquet").filter(F.col("event_date") == "2024-01-05")
    plan = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert back.count() == clicks.filter(F.col("event_date") == "2024-01-05").count() > 0


def test_publish_counts_rows(spark, tmp_path):
    df = spark.range(7)
    assert tables.publish(df, str(tmp_path / "a"), "parquet") == 7
    assert tables.load_table(spark, str(tmp_path / "a"), "parquet").count() == 7


def test_catalog_tables(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    assert tables.publish(df, "adlake_published") == 1
    assert rows(tables.load_table(spark, "adlake_published")) == [(1, "x")]
    assert rows(tables.load_table(spark, "select id from adlake_published", "sql")) == [(1,)]
    tables.register_model(df, "adlake_view")
    tables.register_model(df.filter("id > 1"), "adlake_stored", "table")
    with pytest.raises(ValueError):
        tables.register_model(df, "x", "other")
    listing = tables.catalog_columns(spark).filter(F.col("table_name").startswith("adlake_"))
    expected = [
        (t, c, d, i)
        for t in ("adlake_published", "adlake_stored", "adlake_view")
        for i, (c, d) in enumerate((("id", "int"), ("name", "string")), start=1)
    ]
    assert rows(listing) == sorted(expected, key=lambda r: tuple(map(str, r)))
    assert {r["table_name"]: r["columns"] for r in tables.column_listing(listing).collect()}[
        "adlake_view"
    ] == ["id (int)", "name (string)"]
    spark.sql("drop table adlake_published")
    spark.sql("drop table adlake_stored")


def test_missing_optional_table_is_empty(spark):
    got = tables.load_optional(spark, "no_such_table", schemas.SEGMENTS_SCHEMA)
    assert got.schema == schemas.SEGMENTS_SCHEMA and got.count() == 0


def test_cache_preview_and_csv_export(spark, tmp_path):
    df = tables.cache_result(spark.range(9).withColumn("t", F.lit('a,"b"')))
    assert df.is_cached
    assert tables.preview(df).count() == 5 and tables.preview(df, 50).count() == 9
    tables.export_csv(df, str(tmp_path / "csv"))
    assert landing.read_csv(spark, str(tmp_path / "csv")).filter("t = 'a,\"b\"'").count() == 9
    df.unpersist()


def test_object_store_conf():
    conf = tables.object_store_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert tables.layer_path("s3a://lake/", "silver", "users") == "s3a://lake/silver/users"


def test_staging(spark):
    staged = staged_frames(spark)
    assert [f.dataType.simpleString() for f in staged["campaigns"].schema.fields] == [
        "int", "string", "decimal(20,6)", "string", "string", "date", "date"
    ]
    assert [f.dataType.simpleString() for f in staged["impressions"].schema.fields] == [
        "bigint", "int", "int", "timestamp", "string", "string", "string"
    ]
    assert "impression_id" not in staged["clicks"].columns
    assert "click_id" not in staged["conversions"].columns
    raw = silver_frames(spark)
    assert staged["users"].count() == raw["users"].count() - 1
    assert staged["campaigns"].count() == raw["campaigns"].count() - 1
    assert staged["impressions"].count() == raw["impressions"].count() - 2
    assert staged["clicks"].count() == raw["clicks"].count() - 1
    assert {r[0] for r in staged["users"].select("region").collect()} == {"Us", "Eu", "Apac", None}


def test_lazy_tables_define_on_first_use():
    made = []
    lazy = tables.LazyTables({"a": lambda: made.append("a") or "frame"})
    assert "a" in lazy and "b" not in lazy and list(lazy) == ["a"] and len(lazy) == 1
    assert made == []
    assert lazy["a"] == "frame" and lazy["a"] == "frame" and made == ["a"]


def test_stage_all_takes_what_is_there(spark):
    staged = stage_all({"users": silver_frames(spark)["users"]})
    assert list(staged) == ["users"]


def test_example_models(spark):
    ids = spark.createDataFrame([(1,)], "id int")
    both = examples.with_null_id(ids)
    assert rows(both) == [(1,), (None,)]
    assert rows(examples.equal_to(both, "id", 1)) == [(1,)]
