"""Streaming dedup, with earlier keys known by a streaming aggregate or by the registry itself.

With ``known="counts"`` the state holds one number per key: how many records of it were read. A key is
new in a micro-batch exactly if this number equals its count within the batch.
New keys get the lowest position in the batch as their first one; it goes to the
registry table, where it is never changed. Records of known keys are duplicates,
unless they repeat the very position in the registry. That can only be at or
below a position committed before, which a log read in order does not deliver
again, so the table is consulted for such records alone.

With ``known="registry"`` there is no state: a batch looks its keys up in the bucketed registry
of :mod:`siftline.sinks.ledger`. So the source is read once, keys can be purged and expire,
and the stream can go on from what a job, a backup or another stream left. A batch
then reads the buckets its keys fall into, where the counts touch its keys alone: take
counts where batches are small, keys are many and never forgotten.

Everything runs in the JVM. The aggregate combines before its shuffle, and the
records are matched on offset, partition and key, so a key that holds a third of
a batch unbalances neither.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import guard_key
from ..operators.dedup import first_positions, flag_records, identity
from ..sinks.committed import (
    KickoutHandler,
    commit_batch,
    committed_positions,
    read_registry,
    write_entries,
)
from ..sinks.ledger import dedup_batch, delivered_again
from ..sinks.manifest import BUCKETS, LEASE_SECONDS, writing
from ..sources.positions import collect_positions
from .control import start_batches

_COUNT = "n_seen"

KNOWN = ("counts", "registry")

# So many other streams' last batches are remembered by a root.
_STREAMS = 15


def counted_stream(records: DataFrame, scope: str = "topic", on_null_key: str = "reject") -> DataFrame:
    """The records, together with the running count of each key that occurs in the batch.

    ``n_seen`` is null on records. The output mode is update.
    """
    keys = identity(scope)
    guarded = guard_key(records, on_null_key)
    counts = (
        guarded.where(F.col("key").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT))
    )
    rows = guarded.withColumn(_COUNT, F.lit(None).cast("bigint"))
    return rows.unionByName(counts, allowMissingColumns=True)


def new_keys(batch: DataFrame, scope: str = "topic") -> DataFrame:
    """Registry entries of the keys that a micro-batch of :func:`counted_stream` has first."""
    rows = batch.where(F.col(_COUNT).isNull()).withColumn(
        "_seen", F.date_trunc("second", F.current_timestamp())
    )
    counts = batch.where(F.col(_COUNT).isNotNull()).select(*identity(scope), _COUNT)
    firsts = first_positions(rows, scope, "_seen", "_n")
    return firsts.join(counts, identity(scope)).where(F.col("_n") == F.col(_COUNT)).drop("_n", _COUNT)


def start_dedup(
    records: DataFrame,
    root: str,
    checkpoint: str,
    scope: str = "topic",
    on_null_key: str = "reject",
    on_kickouts: KickoutHandler | None = None,
    interval: str | None = None,
    query_name: str | None = None,
    known: str = "counts",
    seen: str | None = None,
    ttl_seconds: float | None = None,
    buckets: int = BUCKETS,
    lease_seconds: float = LEASE_SECONDS,
) -> StreamingQuery:
    """Dedup a stream into committed batches and a registry below ``root``.

    Without ``interval`` the query reads what is there and ends. A batch that
    fails is replayed by Spark under the same id and rows, and finds what was known before it.

    With ``known="registry"`` the root is one of :class:`~siftline.plans.dedup_job.DedupJob`, whose
    methods read, purge and restore it, also between two batches; its batch ids have no gaps. ``seen``
    names the time to register, ``ttl_seconds`` has keys expire that long after it.
    """
    if known not in KNOWN:
        raise ValueError(f"known must be one of {KNOWN}")
    if known == "registry":
        return _start_registry_dedup(
            records, root, checkpoint, scope, on_null_key, on_kickouts, interval, query_name, seen, ttl_seconds, buckets, lease_seconds
        )
    if seen is not None or ttl_seconds is not None:
        raise ValueError("counts have no time and do not expire")
    committed: dict[int, int] | None = None

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal committed
        spark = batch.sparkSession
        if committed is None:
            committed = collect_positions(committed_positions(spark, root, before=batch_id))
        rows = batch.where(F.col(_COUNT).isNull()).drop(_COUNT)
        firsts = write_entries(new_keys(batch, scope), root, batch_id).drop("first_seen")
        again = delivered_again(rows, committed)
        if again is not None:
            known = read_registry(spark, root, batch_id - 1).drop("first_seen")
            firsts = firsts.unionByName(known.join(again, ["first_offset", "partition", "key"], "left_semi"))
        reached = commit_batch(flag_records(rows, firsts), root, batch_id, on_kickouts)
        committed |= {p: max(o, committed.get(p, o)) for p, o in reached.items()}

    counted = counted_stream(records, scope, on_null_key)
    return start_batches(counted, write, checkpoint, interval, "update", query_name)


def _start_registry_dedup(
    records: DataFrame,
    root: str,
    checkpoint: str,
    scope: str,
    on_null_key: str,
    on_kickouts: KickoutHandler | None,
    interval: str | None,
    query_name: str | None,
    seen: str | None,
    ttl_seconds: float | None,
    buckets: int,
    lease_seconds: float,
) -> StreamingQuery:
    when = F.date_trunc("second", F.current_timestamp()) if seen is None else F.col(seen)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        with writing(spark, root, buckets, lease_seconds) as writer:
            done = writer.current.streams
            if batch_id <= done.get(query, -1):
                # committed, and then stopped before Spark noted it
                return
            cutoff = None if ttl_seconds is None else int((time.time() - ttl_seconds) * 1_000_000)
            others = [(q, b) for q, b in done.items() if q != query][-_STREAMS:]
            dedup_batch(
                writer, batch, writer.current.batch + 1, scope, when, True, on_kickouts, cutoff, dict([*others, (query, batch_id)])
            )

    return start_batches(guard_key(records, on_null_key), write, checkpoint, interval, "append", query_name)
