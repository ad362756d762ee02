"""Registered queries of this package, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontaminate,
    filter_audit,
    hard_negatives,
    licenses,
    mixing,
    near_dedup,
    ngram,
    quality,
    repeats,
    secrets,
    sharding,
    toxicity,
    url_rules,
)
from .tables import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's path is source/lang/doc_id; parts that are null are left out."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", path)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), (*url_rules.SITES, *url_rules.TOPICS))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.judge(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_near_duplicates,
        op3_licenses,
        op4_toxicity,
        op5_shards,
        op6_repeats,
        op7_quality_rules,
        op8_mixture,
        op9_url_rules,
        op10_decontamination,
        op11_filter_audit,
        op12_hard_negatives,
        op13_language_model,
    )
}
ORACLES: dict[str, str] = {
    "op7_quality_rules": quality.ORACLE,
    "op9_url_rules": url_rules.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
