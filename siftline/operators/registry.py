"""The first-seen registry: ``partition, key, first_offset[, first_seen]``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import settle
from ..sources.positions import resume_after, up_to
from .dedup import first_positions, flag_records, identity
from .joins import fits_broadcast, join_skewed


def new_entries(
    batch: DataFrame, registry: DataFrame | None, scope: str = "topic", seen: str | None = None
) -> DataFrame:
    """Entries of the batch for keys the registry does not hold; it is never overwritten."""
    firsts = first_positions(batch, scope, seen)
    if registry is None:
        return firsts
    return firsts.join(registry, identity(scope), "left_anti")


def unregistered(firsts: DataFrame, registry: DataFrame, scope: str = "topic") -> DataFrame:
    """The settled ``firsts`` whose keys the registry does not hold.

    A batch with few keys is broadcast, after measuring it, to pick its keys from
    the registry where they lie, so a large registry is scanned but not shuffled.
    """
    keys = identity(scope)
    if fits_broadcast(firsts):
        registry = registry.join(F.broadcast(firsts.select(*keys)), keys, "left_semi")
    return firsts.join(registry, keys, "left_anti")


def build_registry(records: DataFrame, scope: str = "topic", seen: str | None = None) -> DataFrame:
    """The registry of a whole log."""
    return new_entries(records, None, scope, seen)


def extend_registry(
    registry: DataFrame, batch: DataFrame, scope: str = "topic", seen: str | None = None
) -> DataFrame:
    """Old entries unchanged, plus those of new keys."""
    return registry.unionByName(new_entries(batch, registry, scope, seen))


def lookup(keys: DataFrame, registry: DataFrame, scope: str = "topic") -> DataFrame:
    """Registry entry of each asked key; nulls where there is none."""
    return join_skewed(keys, registry, identity(scope), "left")


def dedup_increment(
    log: DataFrame, registry: DataFrame, committed: dict[int, int], scope: str = "topic"
) -> DataFrame:
    """Flag the records after the committed positions against all earlier keys.

    Registry entries are needed twice, but only by their narrow columns: to tell
    new keys from known ones, and to recognise a replayed first record. A new
    record cannot sit at or below its partition's committed offset, so entries
    there cannot be replays and are filtered out before the wide join.
    """
    fresh = resume_after(log, committed)
    added = new_entries(fresh, registry, scope)
    known = resume_after(
        registry.select("partition", "key", F.col("first_offset").alias("offset")), committed
    ).withColumnRenamed("offset", "first_offset")
    return flag_records(fresh, added.unionByName(known))


def purge(registry: DataFrame, cutoff: datetime | str | Column) -> DataFrame:
    """Forget keys first seen before the cut-off; they count as new when they return."""
    return registry.where(F.col("first_seen") >= (cutoff if isinstance(cutoff, Column) else F.lit(cutoff)))


def rebuild(
    log: DataFrame, committed: dict[int, int], scope: str = "topic", seen: str | None = None
) -> DataFrame:
    """The registry as of the committed positions, from the input log alone.

    This equals the lost registry if each partition was read in offset order.
    """
    return build_registry(up_to(log, committed), scope, seen)


def check_rebuild(log: DataFrame, registry: DataFrame, output: DataFrame) -> DataFrame:
    """Values that the rebuilt registry and the output topic disagree on, each once.

    ``side`` is ``missing`` for a first record whose value never reached the
    output, ``unexpected`` for an output value that no first record has. A null equals a null.

    Values are compared by digest: one aggregate with a count for each side finds the digests
    that stand on one side only, and then the values themselves of these, which are few
    unless something went wrong.
    """
    places = registry.select(F.col("first_offset").alias("offset"), "partition", "key")
    digest = F.sha2(F.coalesce(F.concat(F.lit("v"), F.col("value").cast("string")), F.lit("")), 256).alias("digest")
    expected = log.select("offset", "partition", "key", digest).join(places, ["offset", "partition", "key"], "left_semi")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = expected.select("digest", one.alias("a"), none.alias("b")).union(output.select(digest, none, one))
    apart = settle(
        both.groupBy("digest")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where("a = 0 or b = 0")
        .select("digest", F.when(F.col("b") == 0, "missing").otherwise("unexpected").alias("side"))
    )
    sides = []
    for rows, side in ((log, "missing"), (output, "unexpected")):
        wanted = apart.where(F.col("side") == side)
        found = rows.select("value", digest).join(wanted, "digest")
        sides.append(found.groupBy("digest", "side").agg(F.first("value").alias("value")).select("value", "side"))
    return sides[0].unionByName(sides[1])


def backup(registry: DataFrame, path: str, batch_id: int) -> None:
    """Snapshot the registry as of a batch; writing a batch again replaces it."""
    registry.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def restore(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The snapshot as of a batch."""
    return spark.read.parquet(f"{path}/batch_id={batch_id}")


def save_bucketed(registry: DataFrame, table: str, buckets: int, scope: str = "topic") -> None:
    """Store the registry bucketed and sorted by its identity.

    Later joins on the identity read it in place and shuffle only the batch.
    """
    keys = identity(scope)
    registry.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
