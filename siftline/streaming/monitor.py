"""Progress, commit and state reports of streaming queries."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sinks.committed import commits

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("trigger_time", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("end_offset", T.StringType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("operator", T.StringType()),
        T.StructField("partitions", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("memory_bytes", T.LongType()),
        T.StructField("load_ms", T.LongType()),
        T.StructField("late_rows", T.LongType()),
    ]
)


RUN_STATE = T.StructType([T.StructField("run_id", T.StringType()), *STATE.fields])


def _row(progress) -> tuple:
    states = progress.stateOperators
    sources = progress.sources
    return (
        str(progress.id),
        str(progress.runId),
        progress.name,
        progress.batchId,
        str(progress.timestamp),
        progress.numInputRows,
        progress.batchDuration,
        sum(s.numRowsTotal for s in states),
        sum(s.numRowsDroppedByWatermark for s in states),
        str(sources[0].endOffset) if sources else None,
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent micro-batches of a query, one row each; Spark keeps a fixed number."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS)


def _state_rows(progress) -> list[tuple]:
    return [
        (
            progress.batchId,
            s.operatorName,
            s.numShufflePartitions,
            s.numRowsTotal,
            s.memoryUsedBytes,
            s.customMetrics.get("rocksdbLoadLatencyMs"),
            s.numRowsDroppedByWatermark,
        )
        for s in progress.stateOperators
    ]


def state_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Per recent micro-batch and stateful operator: entries, memory and time to load the state.

    Spark keeps a fixed number of micro-batches of one run; :class:`StateLog` keeps all of all runs.
    """
    return spark.createDataFrame([r for p in query.recentProgress for r in _state_rows(p)], STATE)


def _state_variables(properties: str | None) -> list[str]:
    """Names of an operator's own state variables; none for Spark's built-in operators."""
    raw = json.loads(properties) if properties else {}
    infos = raw.get("stateVariables", [])
    return sorted(v["stateName"] for v in (json.loads(infos) if isinstance(infos, str) else infos) if not v["stateName"].startswith("$"))


def restored_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``operator, state, partition, entries, newest_batch``: what a restart restores, or did as of a batch.

    One row per stateful operator, state variable and state partition, also for empty ones.
    How long a restart took to load them is in :class:`StateLog`.
    """
    operators = spark.read.format("state-metadata").load(checkpoint).distinct().collect()
    found = None
    for op in {(o["operatorId"], o["operatorName"], o["numPartitions"], o["maxBatchId"], o["operatorProperties"]) for o in operators}:
        number, name, partitions, newest, properties = op
        for state in _state_variables(properties) or [None]:
            reader = spark.read.format("statestore").option("operatorId", number)
            if state is not None:
                reader = reader.option("stateVarName", state)
            if batch_id is not None:
                reader = reader.option("batchId", batch_id)
            held = reader.load(checkpoint).groupBy("partition_id").agg(F.count(F.lit(1)).alias("entries"))
            rows = (
                spark.range(partitions)
                .join(held, F.col("id") == F.col("partition_id"), "left")
                .select(
                    F.lit(name).alias("operator"),
                    F.lit(state or "default").alias("state"),
                    F.col("id").cast("int").alias("partition"),
                    F.coalesce("entries", F.lit(0)).cast("long").alias("entries"),
                    F.lit(newest if batch_id is None else batch_id).cast("long").alias("newest_batch"),
                )
            )
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], "operator string, state string, partition int, entries long, newest_batch long")
    return found


class _ProgressLog(StreamingQueryListener):
    """Appends rows per finished micro-batch to a table folder, of one query name or of all."""

    schema: T.StructType

    def __init__(self, spark: SparkSession, path: str, name: str | None = None):
        self._spark = spark
        self._path = path
        self._name = name

    def rows(self, progress) -> list[tuple]:
        raise NotImplementedError

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self._name is not None and progress.name != self._name:
            return
        found = self.rows(progress)
        if found:
            self._spark.createDataFrame(found, self.schema).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class CommitLog(_ProgressLog):
    """One row per finished micro-batch.

    A dedup stream reads its source twice per batch, and Spark's count of input rows
    has both. With ``root``, its output folder, the count is that of the batch's
    commit marker: the records read, 0 for a batch that left no marker.
    """

    schema = PROGRESS

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, root: str | None = None):
        super().__init__(spark, path, name)
        self._root = root

    def rows(self, progress) -> list[tuple]:
        row = dict(zip(PROGRESS.fieldNames(), _row(progress)))
        if self._root is not None:
            marker = commits(self._spark, self._root).where(F.col("batch_id") == progress.batchId)
            row["input_rows"] = marker.agg(F.sum("n_in")).first()[0] or 0
        return [tuple(row.values())]


class StateLog(_ProgressLog):
    """One row per finished micro-batch and stateful operator, with the run it belongs to.

    The first batch of a run shows what was restored: its ``state_rows`` hold the
    entries of earlier runs, ``load_ms`` the time it took to load them.
    """

    schema = RUN_STATE

    def rows(self, progress) -> list[tuple]:
        return [(str(progress.runId), *r) for r in _state_rows(progress)]


@contextmanager
def logged(spark: SparkSession, *logs: StreamingQueryListener) -> Iterator[None]:
    """Have the listeners on for the duration of a block."""
    for log in logs:
        spark.streams.addListener(log)
    try:
        yield
    finally:
        for log in logs:
            spark.streams.removeListener(log)
