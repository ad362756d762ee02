"""First-seen semantics on bounded record logs.

A record is a duplicate exactly if its position differs from the first position
registered for its key. The first positions come from a partially aggregated
``min``: a hot key shrinks to one row per map task. Every record is then matched
on offset, partition and key, not on key alone: only copies of one record share
a join key, so a key that holds a third of the log is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import guard_key

SCOPES = ("topic", "partition")


def identity(scope: str) -> list[str]:
    """Columns that identify a key: alone, or together with its source partition."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    return ["key"] if scope == "topic" else ["partition", "key"]


def first_positions(
    records: DataFrame, scope: str = "topic", seen: str | None = None, count: str | None = None
) -> DataFrame:
    """``partition, key, first_offset[, first_seen][, count]``: one row per key.

    In topic scope, positions are ordered by (partition, offset). ``seen`` names
    the time column to take over from the first record, ``count`` a new column
    for the number of records of the key.
    """
    keys = identity(scope)
    keyed = records.where(F.col("key").isNotNull())
    if scope == "partition" and seen is None and count is None:
        return keyed.groupBy(*keys).agg(F.min("offset").alias("first_offset"))
    place = [c for c in ("partition", "offset") if c not in keys]
    fields = place + ([seen] if seen else [])
    aggs = [F.min(F.struct(*fields)).alias("_first")]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    first = keyed.groupBy(*keys).agg(*aggs)
    columns = [
        F.col("partition") if "partition" in keys else F.col("_first.partition").alias("partition"),
        F.col("key"),
        F.col("_first.offset").alias("first_offset"),
    ]
    if seen:
        columns.append(F.col(f"_first.{seen}").alias("first_seen"))
    if count:
        columns.append(F.col(count))
    return first.select(*columns)


def flag_records(records: DataFrame, firsts: DataFrame) -> DataFrame:
    """Add ``is_duplicate``, given the first position of every key in ``records``.

    Null means that the record has no key and gets no verdict.
    """
    marks = firsts.select(
        F.col("first_offset").alias("offset"), "partition", "key", F.lit(False).alias("_repeat")
    )
    verdict = F.when(F.col("key").isNotNull(), F.coalesce("_repeat", F.lit(True)))
    return records.join(marks, ["offset", "partition", "key"], "left").select(
        *records.columns, verdict.alias("is_duplicate")
    )


def classify(
    records: DataFrame,
    registry: DataFrame | None = None,
    scope: str = "topic",
    on_null_key: str = "reject",
) -> DataFrame:
    """Flag each record as duplicate or not, in one batch or against a registry.

    The registry wins over the batch: a key it holds keeps its recorded first
    position, even if the batch has a lower one, and a record at exactly that
    position is a replay and no duplicate.
    """
    guarded = guard_key(records, on_null_key)
    firsts = first_positions(guarded, scope)
    if registry is not None:
        known = registry.select("partition", "key", "first_offset")
        firsts = firsts.join(known, identity(scope), "left_anti").unionByName(known)
    return flag_records(guarded, firsts)


def uniques(flagged: DataFrame) -> DataFrame:
    """Records to pass on."""
    return flagged.where(~F.col("is_duplicate")).drop("is_duplicate")


def kickouts(flagged: DataFrame) -> DataFrame:
    """Duplicates to report."""
    return flagged.where("is_duplicate").drop("is_duplicate")


def keep_first(records: DataFrame, scope: str = "topic") -> DataFrame:
    """The first record of each key, once.

    One aggregate and no join. Unlike :func:`uniques` it also folds copies of
    the very same record into one.
    """
    return _pick(records, scope, F.min_by)


def keep_latest(records: DataFrame, scope: str = "topic") -> DataFrame:
    """The last record of each key: log compaction, which is not dedup."""
    return _pick(records, scope, F.max_by)


def _pick(records: DataFrame, scope: str, choose) -> DataFrame:
    keys = identity(scope)
    rest = [c for c in records.columns if c not in keys]
    place = F.struct(*[c for c in ("partition", "offset") if c not in keys])
    return (
        records.where(F.col("key").isNotNull())
        .groupBy(*keys)
        .agg(choose(F.struct(*rest), place).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in records.columns])
    )
