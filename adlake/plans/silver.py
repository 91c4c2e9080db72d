"""Bronze JSON records to typed, deduplicated silver tables.

All functions but ``clean_and_rejected`` work on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.scalars import lower_text, text, tolerant_int
from adlake.session import materialize
from adlake.sources.schemas import ENTITY_SPECS, MONEY_COLUMNS, record_schema

_PARSERS = {
    "int": tolerant_int,
    "long": lambda c: tolerant_int(c, "bigint"),
    "double": lambda c: text(c).try_cast("double"),
    "date": lambda c: text(c).try_cast("date"),
    "timestamp": lambda c: text(c).try_cast("timestamp"),
    "lower": lower_text,
    "text": text,
}


def parse_value(raw: Column, kind: str) -> Column:
    """A text value as its declared type; null if it does not parse."""
    return _PARSERS[kind](raw)


def parse_records(bronze: DataFrame, entity: str, as_map: bool = False) -> DataFrame:
    """JSON records to typed columns; unreadable records give a row of nulls.

    Records are read with the declared keys only, so unused JSON fields are never
    built; ``as_map`` reads every key into a string map first.
    """
    shape = T.MapType(T.StringType(), T.StringType()) if as_map else record_schema(entity)
    data = F.from_json("json_record", shape)
    parsed = bronze.select(data.alias("data"))
    return parsed.select(
        *[
            parse_value(F.col("data").getItem(name), kind).alias(name)
            for name, kind in ENTITY_SPECS[entity]
        ]
    )


def trim_text_columns(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(c) for c in texts}) if texts else df


def repair_money(df: DataFrame, entity: str, forbid_negative: bool = False) -> DataFrame:
    """Money columns as double; with ``forbid_negative`` a value below zero becomes null."""
    for name in MONEY_COLUMNS.get(entity, ()):
        value = F.col(name).try_cast("double")
        df = df.withColumn(name, F.when(value >= 0, value) if forbid_negative else value)
    return df


def silver(
    bronze: DataFrame, entity: str, forbid_negative: bool = False, as_map: bool = False
) -> DataFrame:
    """Typed rows of one entity without exact duplicates."""
    rows = trim_text_columns(parse_records(bronze, entity, as_map)).dropDuplicates()
    return repair_money(rows, entity, forbid_negative)


_REJECTS = "array<struct<column_name: string, value: string, reason: string>>"


def _parsed_with_rejects(bronze: DataFrame, entity: str) -> DataFrame:
    """Typed columns, what was rejected of each record, and the record where anything was."""
    data = F.from_json("json_record", record_schema(entity))
    raw = bronze.select("json_record", data.alias("data"))
    # Keys alone tell a broken record: a null or an object without the declared keys.
    broken = F.get_json_object("json_record", "$").isNull()

    def reject(name: str, value: Column, reason: str) -> Column:
        return F.struct(F.lit(name).alias("column_name"), value.alias("value"), F.lit(reason).alias("reason"))

    typed, found = [], []
    for name, kind in ENTITY_SPECS[entity]:
        value = F.col("data").getItem(name)
        parsed = parse_value(value, kind)
        typed.append(parsed.alias(name))
        found.append(F.when(value.isNotNull() & parsed.isNull(), reject(name, value, f"no {kind}")))
    whole = F.array(reject("json_record", F.lit(None).cast("string"), "no JSON object"))
    rejects = F.when(broken, whole).otherwise(F.filter(F.array(*found), lambda r: r.isNotNull()))
    out = raw.select(*typed, rejects.cast(_REJECTS).alias("_rejects"), "json_record")
    record = F.when(F.size("_rejects") > 0, F.col("json_record"))
    return out.withColumn("json_record", record)


def clean_and_rejected(
    bronze: DataFrame, entity: str, forbid_negative: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``silver`` of the records, and what it could not take: both from one pass over them.

    Rejected values are rows (json_record, column_name, value, reason), one for each value
    that its column's type rejects, with the record it came in; a record that is no JSON
    object is one row for column ``json_record``. Copies are kept, as they count.
    """
    once = materialize(_parsed_with_rejects(bronze, entity), "parsed")
    rows = trim_text_columns(once.drop("_rejects", "json_record")).dropDuplicates()
    rejected = once.filter(F.size("_rejects") > 0).select("json_record", F.inline("_rejects"))
    return repair_money(rows, entity, forbid_negative), rejected


def count_rejected(rejected: DataFrame, entity: str) -> DataFrame:
    """``unparsed_values`` from the rejected values: a row for every column, also of none."""
    names = ["json_record", *[name for name, _ in ENTITY_SPECS[entity]]]
    counts = [F.count_if(F.col("column_name") == n).alias(n) for n in names]
    found = rejected.agg(*counts)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unparsed")) for c in names]
    return found.select(F.inline(F.array(*rows)))


def unparsed_values(bronze: DataFrame, entity: str) -> DataFrame:
    """Rows (column_name, unparsed): values present in the records that their type rejects.

    The row ``json_record`` counts the records that are no JSON objects. One pass.
    """
    specs = ENTITY_SPECS[entity]
    data = F.from_json("json_record", record_schema(entity))
    raw = bronze.select("json_record", data.alias("data"))
    # Keys alone tell a broken record: a null or an object without the declared keys.
    broken = F.get_json_object("json_record", "$").isNull()
    counts = [F.count_if(broken).alias("json_record")]
    for name, kind in specs:
        value = F.col("data").getItem(name)
        given = value.isNotNull() & ~broken
        counts.append(F.count_if(given & parse_value(value, kind).isNull()).alias(name))
    found = raw.agg(*counts)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unparsed")) for c in found.columns
    ]
    return found.select(F.inline(F.array(*rows)))
