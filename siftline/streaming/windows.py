"""Event-time buffers that say what became of every event.

Spark's watermark drops late rows and rows without a time unseen. Here the watermark is
kept beside the output, so a batch can be split by it: what is in time is stored
as a piece of its window, the rest is written as rejects of the same batch. A window
whose end the watermark has passed is read from its pieces, sorted and flushed. All of
it runs in the JVM; there is no state but tables.

Layout below a root folder::

    pieces/window=W/batch_id=N/   events in time, W in microseconds; goes once the window is flushed
    rejects/batch_id=N/           events that no flush has, with their reason
    flushes/flush_start=T/        sorted events of a closed window
    marks/batch_id=N/             watermark, open windows and counts; written last
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.buffer import EVENT_COLUMNS, bad_event, emit, flush_window, prepare, sort_flushes, upsert
from ..sinks.committed import read_or_empty, write_flushes
from ..sinks.manifest import delete_folder
from .control import start_batches

MARK = (
    "batch_id bigint, watermark bigint, open array<struct<window:bigint,n:bigint>>, closed array<bigint>, "
    "n_in bigint, n_late bigint, n_untimed bigint, n_bad bigint, n_flushed bigint, n_superseded bigint"
)
REJECT = "batch_id bigint, partition int, offset bigint, ts timestamp, eventType string, id string, payload string, reason string"
_PIECE = "partition int, sort_key string, offset bigint, eventType string, id string, payload string, window bigint, batch_id bigint"
_FLUSHED = "partition int, pos bigint, flush_start timestamp"


def marks(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: the watermark after it, the windows left open, and its counts."""
    return read_or_empty(spark, f"{root}/marks", MARK)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Events of finished batches that no flush has: ``late``, ``untimed``, or of what :func:`bad_event` says."""
    newest = marks(spark, root).agg(F.max("batch_id")).first()[0]
    rows = read_or_empty(spark, f"{root}/rejects", REJECT)
    return rows.where(F.col("batch_id") <= F.lit(-1 if newest is None else newest))


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """``outcome, n`` over all finished batches; the counts add up to the input."""
    done = marks(spark, root)
    left = done.groupBy().agg(F.max_by("open", "batch_id").alias("w")).select(F.aggregate("w", F.lit(0).cast("bigint"), lambda n, x: n + x.n).alias("n"))
    summed = done.select(F.explode(F.create_map(*[x for c in ("late", "untimed", "bad", "flushed", "superseded") for x in (F.lit(c), F.col(f"n_{c}"))])).alias("outcome", "n"))
    return summed.groupBy("outcome").agg(F.sum("n").alias("n")).unionByName(left.select(F.lit("open").alias("outcome"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval})").first()[0]


def start_window_split(
    events: DataFrame,
    root: str,
    checkpoint: str,
    interval: str,
    lateness: str = "0 seconds",
    ts: str = "ts",
    across_lanes: bool = False,
    trigger_interval: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Flush event-time windows, and write late, untimed and bad events beside them.

    An event is late if its window had ended, ``lateness`` counted in, at the latest time
    of the batches before its own. Windows close at the end of the batch that brings
    the watermark past them. Every write of a batch replaces its own folders and the mark
    comes last, so a batch that Spark repeats leaves what it would have left. Without
    ``trigger_interval``, read what is there and end. The number of open windows should stay in the
    thousands; each is a folder and an entry of the mark.
    """
    start = flush_window(interval, ts)
    size, delay = _micros(events.sparkSession, interval), _micros(events.sparkSession, lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = marks(spark, root).where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        watermark = before["watermark"] if before else None
        held = {w: n for w, n in before["open"]} if before else {}
        for w in before["closed"] if before else ():
            delete_folder(spark, f"{root}/pieces/window={w}")
        late = F.lit(False) if watermark is None else F.col("window") + size <= watermark
        rows = batch.select(
            F.col("partition").cast("int").alias("partition"),
            F.col("offset").cast("bigint").alias("offset"),
            *EVENT_COLUMNS,
            F.col(ts).cast("timestamp").alias("ts"),
            F.unix_micros(start.cast("timestamp")).alias("window"),
        ).withColumn("reason", F.coalesce(bad_event(), F.when(F.col("ts").isNull(), "untimed"), F.when(late, "late")))

        # as many rows as the batch has windows, times the reasons
        found = rows.groupBy("window", "reason").agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_micros("ts")).alias("newest")).collect()
        n = {"late": 0, "untimed": 0, None: 0}
        for r in found:
            n[r["reason"]] = n.get(r["reason"], 0) + r["n"]
            if r["reason"] is None:
                held[r["window"]] = held.get(r["window"], 0) + r["n"]
        times = [r["newest"] - delay for r in found if r["reason"] in (None, "late")]
        watermark = max([*times, *([] if watermark is None else [watermark])], default=None)
        closed = sorted(w for w in held if watermark is not None and w + size <= watermark)

        rows.where("reason is not null").drop("window").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{root}/rejects/batch_id={batch_id}"
        )
        (
            upsert(prepare(rows.where("reason is null")), "window")
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window", "batch_id")
            .parquet(f"{root}/pieces")
        )
        flushed = 0
        if closed:
            folders = [f"{root}/pieces/window={w}" for w in closed]
            pieces = spark.read.schema(_PIECE).option("basePath", f"{root}/pieces").parquet(*folders)
            whole = pieces.where(F.col("batch_id") <= batch_id).withColumn("flush_start", F.timestamp_micros("window"))
            write_flushes(emit(sort_flushes(upsert(whole, "flush_start"), "flush_start", across_lanes), "flush_start"), f"{root}/flushes", "flush_start")
            ended = F.unix_micros("flush_start").isin(closed)
            flushed = spark.read.schema(_FLUSHED).parquet(f"{root}/flushes").where(ended).count()
        taken = sum(held.pop(w) for w in closed)
        bad = sum(n.values()) - n["late"] - n["untimed"] - n[None]
        mark = (watermark, sorted(held.items()), closed, sum(n.values()), n["late"], n["untimed"], bad, flushed, taken - flushed)
        spark.createDataFrame([mark], MARK.replace("batch_id bigint, ", "")).coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch_id={batch_id}")

    return start_batches(events, write, checkpoint, trigger_interval, query_name=query_name)
