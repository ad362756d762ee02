"""Streaming dedup with the registry in keyed state, which can expire and be restored.

Only ``partition, offset, key`` go through the stateful operator, combined per
chunk before the shuffle. It answers with the first position of each key of the
micro-batch, and the full records are then flagged by the batch operator. So wide
rows stay in the JVM, and a key that holds a third of the batch neither sends its
rows through one state handler nor through one join task.

The handler costs a call per key and batch. :mod:`siftline.streaming.dedup` has
no such cost; use this form where keys must expire, where the state must start
from a registry, or where running state is to be looked into.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions.keys import guard_key
from ..operators.dedup import flag_records, identity
from ..sinks.committed import KickoutHandler, commit_batch
from .control import start_batches

# Send the handlers to the Python workers by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PLACE = "partition int, offset bigint, key string, seen timestamp"
_FIRST = "partition int, key string, first_offset bigint"


def _lowest_by(keys: list[str]):
    """A combiner that keeps, per chunk of rows, the lowest position of each key."""

    def combine(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield chunk.sort_values(["partition", "offset"]).drop_duplicates(keys)

    return combine


class FirstPosition(StatefulProcessor):
    """Remembers where a key was first processed; the entry is written once."""

    def __init__(self, ttl_ms: int | None = None):
        self._ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self._first = handle.getValueState(
            "first", "partition int, first_offset bigint, first_seen timestamp", self._ttl_ms
        )

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._first.update((initialState["partition"], initialState["first_offset"], initialState["first_seen"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._first.get()
        if known is None:
            lowest = min(rows, key=lambda r: (r["partition"], r["offset"]))
            known = (lowest["partition"], lowest["offset"], lowest["seen"])
            self._first.update(known)
        yield Row(partition=known[0], key=key[-1], first_offset=known[1])

    def close(self) -> None:
        pass


def first_position_stream(
    records: DataFrame,
    scope: str = "topic",
    ttl_seconds: int | None = None,
    restore: DataFrame | None = None,
) -> DataFrame:
    """Per micro-batch, the first position of each key that occurs in it.

    ``ttl_seconds`` purges entries that old; it needs processing time, so the
    query must then run on a timed trigger. ``restore`` is a registry to begin
    with on a new checkpoint, such as a backup or a rebuilt one.
    """
    keys = identity(scope)
    seen = F.date_trunc("second", F.current_timestamp()).alias("seen")
    places = (
        records.where(F.col("key").isNotNull())
        .select("partition", "offset", "key", seen)
        .mapInPandas(_lowest_by(keys), _PLACE)
    )
    return places.groupBy(*keys).transformWithState(
        FirstPosition(None if ttl_seconds is None else ttl_seconds * 1000),
        outputStructType=_FIRST,
        outputMode="append",
        timeMode="None" if ttl_seconds is None else "ProcessingTime",
        initialState=None if restore is None else restore.groupBy(*keys),
    )


def keyed_stream(
    records: DataFrame,
    scope: str = "topic",
    ttl_seconds: int | None = None,
    on_null_key: str = "reject",
    restore: DataFrame | None = None,
) -> DataFrame:
    """The records, together with the first positions needed to flag them.

    ``first_offset`` is null on records. :func:`flag_keyed_batch` turns a
    micro-batch of this stream into flagged records.
    """
    guarded = guard_key(records, on_null_key)
    firsts = first_position_stream(guarded, scope, ttl_seconds, restore)
    rows = guarded.withColumn("first_offset", F.lit(None).cast("bigint"))
    return rows.unionByName(firsts, allowMissingColumns=True)


def flag_keyed_batch(batch: DataFrame) -> DataFrame:
    """``is_duplicate`` for the records of one micro-batch of :func:`keyed_stream`."""
    rows = batch.where(F.col("first_offset").isNull()).drop("first_offset")
    firsts = batch.where(F.col("first_offset").isNotNull())
    return flag_records(rows, firsts)


def start_keyed_dedup(
    records: DataFrame,
    root: str,
    checkpoint: str,
    scope: str = "topic",
    ttl_seconds: int | None = None,
    on_null_key: str = "reject",
    on_kickouts: KickoutHandler | None = None,
    interval: str | None = None,
    restore: DataFrame | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Dedup a stream into committed batches below ``root``.

    Without ``interval`` the query reads what is there and ends; with
    ``ttl_seconds`` it needs one. A batch that fails is replayed by Spark under
    the same id and rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        commit_batch(flag_keyed_batch(batch), root, batch_id, on_kickouts)

    keyed = keyed_stream(records, scope, ttl_seconds, on_null_key, restore)
    return start_batches(keyed, write, checkpoint, interval, query_name=query_name)


def live_registry(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The registry in a query's state, now or as of a batch: look-up and backup.

    The columns are those of the table form.
    """
    reader = spark.read.format("statestore").option("stateVarName", "first")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select(
        "value.partition",
        "key.key",
        "value.first_offset",
        "value.first_seen",
    )
