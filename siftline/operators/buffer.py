"""Buffer events for an interval, keep the latest per key, emit each buffer sorted.

Buffers belong to a lane, the source partition. A flush is identified by the
column the caller flushes by: an event-time window or the batch of arrival.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.events import sort_key, upper_payload
from .ranking import with_stored_position

EVENT_COLUMNS = ["eventType", "id", "payload"]


def flush_window(interval: str, ts: str = "ts") -> Column:
    """Start of the event's window; the window is closed ``interval`` later.

    Windows are aligned to the epoch, and the start has the type of ``ts``. By arithmetic, as the
    built-in window function takes rows without a time out of the whole frame; here they
    get a null. Months and years have no fixed length: use ``date_trunc`` for those.
    """
    if re.search(r"(?i)\b(month|quarter|year)s?\b", interval):
        raise ValueError(f"{interval} has no fixed length; flush by date_trunc instead")
    past = f"pmod(unix_micros(CAST({ts} AS TIMESTAMP)), unix_micros(timestamp_micros(0) + INTERVAL {interval}))"
    return F.expr(f"{ts} - make_dt_interval(0, 0, 0, CAST({past} / 1000000BD AS DECIMAL(18, 6)))")


def bad_event() -> Column:
    """Why an event cannot be buffered; null for a good one."""
    return F.when(F.col("eventType").isNull(), "missing type").when(F.col("payload").isNull(), "missing payload")


def bad_events(events: DataFrame) -> DataFrame:
    """The events that ``on_bad_event="reject"`` leaves out, with their reason."""
    return events.withColumn("reason", bad_event()).where("reason is not null")


def prepare(events: DataFrame, on_bad_event: str = "fail") -> DataFrame:
    """Upper-case the payload and add the sort key, in this order, before buffering.

    An event without type or payload fails the run, or is left out with ``reject``;
    :func:`bad_events` has those.
    """
    if on_bad_event not in ("fail", "reject"):
        raise ValueError("on_bad_event must be fail or reject")
    if on_bad_event == "reject":
        return upper_payload(events.where(bad_event().isNull())).withColumn("sort_key", sort_key())
    checked = F.when(bad_event().isNull(), sort_key()).otherwise(
        F.raise_error(F.concat(F.lit("event cannot be buffered: "), bad_event())).cast("string")
    )
    return upper_payload(events).withColumn("sort_key", checked)


def upsert(events: DataFrame, flush: str = "flush_id", keep: list[str] | None = None) -> DataFrame:
    """One row per (flush, lane, sort key): the event at the highest offset.

    The hash leads the grouping columns because this aggregate sorts: few flushes
    and long keys with a common start would make every comparison a long one.
    """
    kept = [*EVENT_COLUMNS, *(keep or [])]
    return (
        events.groupBy(F.xxhash64("sort_key").alias("_hash"), flush, "partition", "sort_key")
        .agg(F.max_by(F.struct("offset", *kept), "offset").alias("_last"))
        .select(flush, "partition", "sort_key", "_last.*")
    )


def sort_flushes(buffered: DataFrame, flush: str = "flush_id", across_lanes: bool = False) -> DataFrame:
    """Add ``pos``, the place of the event in its flush by the bytes of the sort key.

    With ``across_lanes`` the lanes of a flush are merged into one order; equal
    keys of different lanes follow the lane number.
    """
    groups = [flush] if across_lanes else [flush, "partition"]
    order = ["sort_key", "partition"] if across_lanes else ["sort_key"]
    return with_stored_position(buffered, groups, order)


def emit(sorted_rows: DataFrame, flush: str = "flush_id") -> DataFrame:
    """The flushed layout: null record key, then the event."""
    return sorted_rows.select(
        flush, "partition", "pos", F.lit(None).cast("string").alias("key"), *EVENT_COLUMNS
    )


def buffer_and_sort(
    events: DataFrame, flush: str = "flush_id", across_lanes: bool = False, on_bad_event: str = "fail"
) -> DataFrame:
    """Upper-case, upsert and sort: what each flush sends on."""
    return emit(sort_flushes(upsert(prepare(events, on_bad_event), flush), flush, across_lanes), flush)


def closed(buffered: DataFrame, watermark: Column, interval: str, flush: str = "flush_id") -> DataFrame:
    """Buffers whose window has ended at the watermark: they are flushed and cleared."""
    return buffered.where(F.col(flush) + F.expr(f"INTERVAL {interval}") <= watermark)


def pending(buffered: DataFrame, watermark: Column, interval: str, flush: str = "flush_id") -> DataFrame:
    """Buffers that are still open at the watermark."""
    return buffered.where(F.col(flush) + F.expr(f"INTERVAL {interval}") > watermark)


def pending_size(buffered: DataFrame) -> DataFrame:
    """Entries per lane still in the buffer."""
    return buffered.groupBy("partition").agg(F.count(F.lit(1)).alias("n_pending"))


def peek(buffered: DataFrame, key: str) -> DataFrame:
    """The buffered event of one sort key."""
    return buffered.where(F.col("sort_key") == key)
