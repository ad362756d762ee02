"""Buffer-and-sort of a bounded log of event JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.event_json import event_rejects, good_events, parse_events
from ..operators.buffer import buffer_and_sort
from ..sinks.committed import write_flushes


def sort_log(
    records: DataFrame,
    flush: Column,
    path: str,
    rejects_path: str | None = None,
    across_lanes: bool = False,
    on_error: str = "reject",
) -> None:
    """Parse, upper-case, upsert and sort each flush, and write one folder per flush.

    ``flush`` says which flush a record belongs to: an event-time window
    (:func:`siftline.operators.buffer.flush_window`) or the batch of arrival.
    Rows that are no events, or belong to no flush because their time is missing, go to
    ``rejects_path`` with their reason.
    """
    parsed = parse_events(records.withColumn("flush_id", flush), on_error=on_error)
    untimed = F.lit("missing time")
    if on_error == "fail":
        untimed = F.raise_error(F.concat(F.lit("bad event: "), untimed)).cast("string")
    parsed = parsed.withColumn("reason", F.coalesce("reason", F.when(F.col("flush_id").isNull(), untimed)))
    if rejects_path is not None:
        event_rejects(parsed).write.mode("overwrite").parquet(rejects_path)
    write_flushes(buffer_and_sort(good_events(parsed), across_lanes=across_lanes), path)
