"""Streaming buffer and sort.

Three ways to hold a buffer: the micro-batch itself (:func:`start_trigger_sort`),
keyed state with wall-clock timers (:func:`start_buffer_sort`), and event-time
windows (:func:`start_window_sort`). The first and the last run in the JVM alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.buffer import EVENT_COLUMNS, buffer_and_sort, emit, prepare, sort_flushes, upsert
from ..sinks.committed import write_flushes
from .control import start_batches

# Send the handlers to the Python workers by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK = 10_000
_ROW = "flush_id bigint, partition int, shard int, sort_key string, offset bigint, " \
       "eventType string, id string, payload string"
_EVENT = "offset bigint, eventType string, id string, payload string"
_FLUSHED = "flush_id bigint, partition int, sort_key string, " + _EVENT
_ENTRY = ["offset", *EVENT_COLUMNS]


def _latest(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep, per chunk of rows, the last event of each sort key."""
    for chunk in chunks:
        yield chunk.sort_values("offset").drop_duplicates(["partition", "sort_key"], keep="last")


class EventBuffer(StatefulProcessor):
    """One shard of one lane's buffer for one tick: chunks of events as they came.

    The tick is part of the grouping key: events after a boundary open the next
    buffer while the old one waits for its timer. A chunk is one call to the state, both when it
    is added and when it is flushed; which event of a sort key is the latest is decided
    after the flush, by an aggregate in the JVM.
    """

    def __init__(self, interval_ms: int):
        self._interval_ms = interval_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._buffer = handle.getListState("buffer", "sort_key string, " + _EVENT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            # missing ids are null, not the float that pandas makes of them
            plain = chunk[["sort_key", *_ENTRY]].astype(object).where(chunk[["sort_key", *_ENTRY]].notna(), None)
            self._buffer.appendList([(r[0], int(r[1]), *r[2:]) for r in plain.itertuples(index=False)])
        self._handle.registerTimer((int(key[0]) + 1) * self._interval_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._buffer.get()
        while chunk := list(islice(held, _CHUNK)):
            yield pd.DataFrame([(int(key[0]), int(key[1]), *r) for r in chunk], columns=["flush_id", "partition", "sort_key", *_ENTRY])
        self._buffer.clear()

    def close(self) -> None:
        pass


def _with_clock(rows: DataFrame) -> DataFrame:
    """Add a source that always has news and never a row.

    Timers fire only when a micro-batch runs. After a restart without new events
    none would, and what was buffered before would stay there.
    """
    clock = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.unionByName(clock.where(F.lit(False)).select(*nothing))


def buffer_stream(events: DataFrame, interval_seconds: float = 2.0, shards: int | None = None) -> DataFrame:
    """Buffered events, emitted unsorted once the wall-clock tick they arrived in is over.

    An event comes once per chunk that had its sort key; :func:`~siftline.operators.buffer.upsert`
    leaves the latest.

    ``flush_id`` is the number of the tick. A lane is split into ``shards`` by
    sort key (default: the session's shuffle partitions); all shards flush on the
    same ticks, so the split does not show in the result.
    """
    spark = events.sparkSession
    interval_ms = int(interval_seconds * 1000)
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tick = F.expr(f"unix_millis(current_timestamp()) div {interval_ms}")
    rows = (
        prepare(events)
        .select(
            tick.alias("flush_id"),
            "partition",
            F.pmod(F.xxhash64("sort_key"), F.lit(count)).cast("int").alias("shard"),
            "sort_key",
            *_ENTRY,
        )
        .mapInPandas(_latest, _ROW)
    )
    return _with_clock(rows).groupBy("flush_id", "partition", "shard").transformWithStateInPandas(
        EventBuffer(interval_ms),
        outputStructType=_FLUSHED,
        outputMode="append",
        timeMode="ProcessingTime",
    )


def _start_sorted(
    buffered: DataFrame,
    path: str,
    checkpoint: str,
    flush: str,
    across_lanes: bool,
    interval: str | None,
    query_name: str | None,
    latest: bool = False,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = upsert(batch, flush) if latest else batch
        write_flushes(emit(sort_flushes(rows, flush, across_lanes), flush), path, flush)

    return start_batches(buffered, write, checkpoint, interval, query_name=query_name)


def start_trigger_sort(
    events: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "2 seconds",
    across_lanes: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Flush on a wall-clock trigger, with the micro-batch as the buffer.

    What arrived since the last trigger is one flush, numbered by the batch id.
    The source holds the buffer, so there is no state to keep or to restore, a
    crashed flush is read again as it was, and everything runs in the JVM: the
    form for large volumes. Without ``interval``, read what is there and end.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("flush_id", F.lit(batch_id).cast("bigint"))
        write_flushes(buffer_and_sort(rows, across_lanes=across_lanes), path)

    return start_batches(events, write, checkpoint, interval, query_name=query_name)


def start_buffer_sort(
    events: DataFrame,
    path: str,
    checkpoint: str,
    interval_seconds: float = 2.0,
    shards: int | None = None,
    across_lanes: bool = False,
    trigger_interval: str = "1 second",
    query_name: str | None = None,
) -> StreamingQuery:
    """Flush a stateful buffer on a wall-clock interval; each flush goes to its own folder, sorted.

    Unlike :func:`start_trigger_sort` it can be looked into while it fills, and
    several micro-batches share a flush. The query runs until it is stopped. A flush leaves the state in the same
    micro-batch that writes it, so a crash in between replays that batch and
    writes the same folder again.
    """
    return _start_sorted(
        buffer_stream(events, interval_seconds, shards),
        path,
        checkpoint,
        "flush_id",
        across_lanes,
        trigger_interval,
        query_name,
        latest=True,
    )


def window_buffer_stream(
    events: DataFrame, interval: str, lateness: str = "0 seconds", ts: str = "ts"
) -> DataFrame:
    """Long buffers: event-time windows, emitted when the watermark has passed their end.

    Several windows can be open at once, and no wall-clock limit applies. Rows
    later than ``lateness`` are dropped, and counted by the query's progress.
    """
    return (
        prepare(events)
        .withWatermark(ts, lateness)
        .groupBy(F.window(ts, interval).alias("window"), "partition", "sort_key")
        .agg(F.max_by(F.struct("offset", *EVENT_COLUMNS), "offset").alias("_last"))
        .select(F.col("window.start").alias("flush_start"), "partition", "sort_key", "_last.*")
    )


def start_window_sort(
    events: DataFrame,
    path: str,
    checkpoint: str,
    interval: str,
    lateness: str = "0 seconds",
    ts: str = "ts",
    across_lanes: bool = False,
    trigger_interval: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Flush event-time windows; without ``trigger_interval``, read what is there and end."""
    return _start_sorted(
        window_buffer_stream(events, interval, lateness, ts),
        path,
        checkpoint,
        "flush_start",
        across_lanes,
        trigger_interval,
        query_name,
    )


def live_buffer(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The events a running or stopped wall-clock buffer holds: pending size and look-up."""
    reader = spark.read.format("statestore").option("stateVarName", "buffer")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint).select("key.flush_id", "key.partition", "list_element.*")
    return upsert(held)


def drained(query: StreamingQuery) -> bool:
    """Whether the query has lately buffered something and holds nothing back any more."""
    held = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    return any(held) and held[-1] == 0
