"""The stages of the corpus pipeline: each takes documents and returns those it keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import free_name, join_skewed
from . import decontaminate as tiling, mixing, near_dedup, quality, sharding
from .tables import stored, table

SHARDS = 24


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Add a key, 63 bits over id, source and text, and tell its name, which no column had.

    Rows that agree in these are judged alike by every stage.
    """
    parts = [x for c in ("doc_id", "source", "text") for x in (F.col(c), F.col(c).isNull())]
    key = free_name("_key", docs)
    return docs.withColumn(key, F.shiftrightunsigned(F.xxhash64(*parts), 1)), key


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of keyed documents whose key is not among those of ``gone``."""
    return join_skewed(docs, gone.select(key).distinct(), [key], "left_anti")


def kept_rows(docs: DataFrame, key: str, verdicts: DataFrame, keep: Column) -> DataFrame:
    """The rows of keyed documents that a verdict per row keeps, without the key.

    Verdicts carry the key as ``doc_id``. A row goes only if it was rejected itself,
    whatever other rows have its id or have none as well.
    """
    return without(docs, key, verdicts.filter(~keep).select(F.col("doc_id").alias(key))).drop(key)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host fails them, go."""
    docs, key = keyed(docs)
    judged = quality.judge(docs.select(F.col(key).alias("doc_id"), "text", "source"))
    return kept_rows(docs, key, judged, F.col("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 stays: the smallest id.

    Rows that agree in id, source and text are one document, of which one row stays. Different
    texts under one id, or without an id, are different documents; a document without an id
    goes if it is near one that has an id.
    """
    docs, key = keyed(docs)
    own = docs.select(F.col(key).alias("doc_id"), "text")
    found = near_dedup.near_duplicates(own, k=5, percent=80).select(F.col("doc_id").alias("key"), "component_id").distinct()
    ids = docs.groupBy(F.col(key).alias("key")).agg(F.first("doc_id").alias("doc_id"))
    members = stored(found.join(ids, "key"), "members")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    heads = members.groupBy("component_id").agg(F.min(first)["key"].alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = join_skewed(members, heads, ["component_id"], "inner").filter("key <> head")
    return without(docs, key, gone.select(F.col("key").alias(key))).dropDuplicates([key]).drop(key)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    docs, key = keyed(docs)
    own = docs.select(F.col(key).alias("doc_id"), "text")
    found = tiling.contamination(own, table(spark, sf_dir, "benchmark"))
    return kept_rows(docs, key, found, ~F.col("contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as often as the mixture takes it, which may be not at all.

    Rows get a number of their own, with which they are written, so that those that repeat
    an id, or have none, are told apart without being brought together.
    """
    row, copies, copy = (free_name(n, docs) for n in ("_row", "_copies", "_copy"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    taken = mixing.mix(rows.select("doc_id", "text", "source", F.col(row).alias("row")), row="row").filter("copies > 0")
    both = join_skewed(rows, taken.select(F.col("row").alias(row), F.col("copies").cast("int").alias(copies)), [row], "inner")
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    return sharding.shard(docs, SHARDS)
