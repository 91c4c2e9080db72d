"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import (
    blocks,
    centroids,
    conversations,
    decontam,
    langid,
    licenses,
    mixing,
    oracles,
    pii,
    quality,
    simhash,
    suffixes,
    topk,
    warc,
)
from adlake.llm.common import table
from adlake.session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op4_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return left.drop("kept")


def op5_langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents").select("doc_id", "text", "lang"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontam.find_leaks(docs, table(spark, sf, "benchmark")).drop("text_key")


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.rate(docs, table(spark, sf, "labels"))


def op8_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf, "documents").select("doc_id", "text")))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "warc")
    manifest = warc.write_warc(table(spark, sf, "pages"), root)
    return warc.read_warc(manifest, root)


def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations")
    return conversations.repair(given, conversations.damage(given))


def op12_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.extract(table(spark, sf, "pages"))


def op13_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(centroids.whole_vectors(table(spark, sf, "embeddings")))


def queries() -> dict[str, Query]:
    named = (
        op1_mixing,
        op2_simhash,
        op3_licenses,
        op4_suffixes,
        op5_langid,
        op6_decontamination,
        op7_quality,
        op8_topk,
        op9_pii,
        op10_warc,
        op11_conversations,
        op12_main_text,
        op13_centroids,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
