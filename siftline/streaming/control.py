"""Starting, bounding and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import ROCKSDB_PROVIDER, session_conf

# A query takes over these settings when it starts.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A second start on the same checkpoint raises instead of stopping the first.
    "spark.sql.streaming.stopActiveRunOnRestart": "false",
}


def start_exclusive(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Start a query as the only writer of its checkpoint, with durable state."""
    with session_conf(spark, STATE_CONF):
        return writer.start()


def start_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    output_mode: str = "append",
    query_name: str | None = None,
) -> StreamingQuery:
    """Hand each non-empty micro-batch to ``write``; without ``interval``, until the input is used up.

    The batch is kept while it is written, so that its state is computed once
    however often the rows are used. The count computes all of it in one job.
    Streams run without adaptive execution; what is derived from the finished
    batch gets it back, and with it skew handling and measured broadcasts.
    """
    adaptive = {"spark.sql.adaptive.enabled": rows.sparkSession.conf.get("spark.sql.adaptive.enabled")}

    def keep_and_write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.count() > 0:
                with session_conf(batch.sparkSession, adaptive):
                    write(batch, batch_id)
        finally:
            batch.unpersist()

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    writer = (
        rows.writeStream.foreachBatch(keep_and_write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if query_name is not None:
        writer = writer.queryName(query_name)
    return start_exclusive(rows.sparkSession, writer)


def run_to_end(query: StreamingQuery, timeout: float = 600) -> StreamingQuery:
    """Wait for an ``availableNow`` query; stop it and raise when it takes too long."""
    if not query.awaitTermination(int(timeout)):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")
    return query


def run_until(query: StreamingQuery, done: Callable[[], bool], timeout: float = 120) -> None:
    """Let a timed-trigger query run until ``done`` holds, then stop it.

    Processing-time state never lets ``availableNow`` finish, so such a query
    needs an explicit end.
    """
    deadline = time.monotonic() + timeout
    try:
        while not done():
            if not query.isActive:
                failure = query.exception()
                raise failure if failure else RuntimeError("the query ended early")
            if time.monotonic() > deadline:
                raise TimeoutError(f"streaming query not done after {timeout} s")
            time.sleep(0.2)
    finally:
        query.stop()


def wait_for(done: Callable[[], bool], timeout: float = 120) -> None:
    """Return when ``done`` holds; raise when that takes too long."""
    deadline = time.monotonic() + timeout
    while not done():
        if time.monotonic() > deadline:
            raise TimeoutError(f"not done after {timeout} s")
        time.sleep(0.2)


def print_stream(rows: DataFrame, label: str = "output", interval: str = "2 seconds") -> DataStreamWriter:
    """Console writer; the label becomes the query name."""
    return (
        rows.writeStream.format("console")
        .queryName(label)
        .option("truncate", "false")
        .trigger(processingTime=interval)
    )
