"""All-or-none batch output on plain files.

Layout below a root folder::

    registry/batch_id=N/                                first-seen entries the batch added
    records/batch_id=N/outcome=unique|kickout|reject/   the flagged records
    commits/batch_id=N/                                 one row per source partition

A batch is written by overwriting its own folders, the commit marker last, so a
repeated batch replaces what a failed attempt left behind, and readers that go
by the markers never see a part of one. This is the layout of streams, whose batch ids
and replays are Spark's; jobs use :mod:`siftline.sinks.ledger`.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.accounting import batch_accounting
from ..schemas import RECORD, REGISTRY
from ..session import session_conf
from ..sources.batches import read_committed
from ..sources.positions import collect_positions

KickoutHandler = Callable[[DataFrame, int], None]

COMMIT = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("n_in", T.LongType()),
        T.StructField("n_unique", T.LongType()),
        T.StructField("n_dup", T.LongType()),
        T.StructField("n_reject", T.LongType()),
        T.StructField("committed_offset", T.LongType()),
        T.StructField("elapsed_ms", T.LongType()),
    ]
)

_ENTRY = T.StructType([*REGISTRY.fields, T.StructField("batch_id", T.LongType())])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet folder, or no rows if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_outcomes(flagged: DataFrame, target: str) -> DataFrame:
    """Compute the flagged rows and write them once, split by ``outcome``; the rows as written."""
    spark = flagged.sparkSession
    outcome = (
        F.when(F.col("is_duplicate").isNull(), "reject")
        .when(F.col("is_duplicate"), "kickout")
        .otherwise("unique")
    )
    # One open file per outcome and task, instead of sorting the rows by outcome.
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "3"}):
        (
            flagged.withColumn("outcome", outcome)
            .drop("is_duplicate")
            .write.mode("overwrite")
            # whatever a failed attempt left goes, also where the session overwrites by folder
            .option("partitionOverwriteMode", "static")
            .partitionBy("outcome")
            .parquet(target)
        )
    schema = T.StructType(
        [f for f in flagged.schema.fields if f.name != "is_duplicate"]
        + [T.StructField("outcome", T.StringType())]
    )
    return spark.read.schema(schema).parquet(target)


def count_outcomes(written: DataFrame) -> DataFrame:
    """Counts and position per source partition, from two narrow columns of what was written."""
    verdict = F.when(F.col("outcome") == "kickout", True).when(F.col("outcome") == "unique", False)
    # one file, written after the counts are complete
    return batch_accounting(written.withColumn("is_duplicate", verdict), ["partition"]).repartition(1)


def commit_batch(
    flagged: DataFrame, root: str, batch_id: int, on_kickouts: KickoutHandler | None = None
) -> dict[int, int]:
    """Write one flagged batch and then its marker; an empty batch gets none.

    Returns the position reached in each source partition. If the kick-out handler
    raises, no marker is written and the batch is void.
    """
    started = time.monotonic()
    written = write_outcomes(flagged, f"{root}/records/batch_id={batch_id}")
    counts = count_outcomes(written).persist()
    try:
        reached = collect_positions(counts.withColumnRenamed("committed_offset", "offset"))
        if not reached:
            return reached
        if on_kickouts is not None:
            on_kickouts(written.where("outcome = 'kickout'").drop("outcome"), batch_id)
        elapsed = F.lit(int((time.monotonic() - started) * 1000)).cast("bigint")
        marker = counts.withColumn("elapsed_ms", elapsed)
        marker.write.mode("overwrite").parquet(f"{root}/commits/batch_id={batch_id}")
    finally:
        counts.unpersist()
    return reached


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The commit log: one row per batch and source partition."""
    return read_or_empty(spark, f"{root}/commits", COMMIT)


def committed_positions(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Last committed offset per source partition, of all batches or those before an id."""
    done = commits(spark, root)
    if before is not None:
        done = done.where(F.col("batch_id") < before)
    return done.groupBy("partition").agg(F.max("committed_offset").alias("offset"))


def last_batch(spark: SparkSession, root: str) -> int:
    """The newest committed batch id, -1 before the first."""
    newest = commits(spark, root).agg(F.max("batch_id")).first()[0]
    return -1 if newest is None else newest


def read_output(spark: SparkSession, root: str, outcome: str = "unique") -> DataFrame:
    """Committed records of one outcome.

    Folder names prune other outcomes and anything after the newest marker, so a
    batch that is being written or repeated is not opened at all. Delivery order
    is (partition, offset): sort by it where order matters.
    """
    newest = last_batch(spark, root)
    if newest < 0:
        # no batch yet, and so no other columns than those of a record
        return spark.createDataFrame([], T.StructType([*RECORD.fields, T.StructField("batch_id", T.LongType())]))
    rows = spark.read.parquet(f"{root}/records").where((F.col("outcome") == outcome) & (F.col("batch_id") <= newest))
    whole = rows.drop("outcome").withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return read_committed(whole, commits(spark, root))


def write_entries(entries: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Store the registry entries a batch adds; they count once the batch has its marker.

    Read back, they have a known size, by which Spark picks the next join.
    """
    path = f"{root}/registry/batch_id={batch_id}"
    entries.select(*REGISTRY.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return entries.sparkSession.read.schema(REGISTRY).parquet(path)


def read_registry(spark: SparkSession, root: str, upto: int) -> DataFrame:
    """Entries of all batches up to an id; the folder name leaves out later attempts."""
    entries = read_or_empty(spark, f"{root}/registry", _ENTRY)
    return entries.where(F.col("batch_id") <= upto).drop("batch_id")


def append_new(rows: DataFrame, path: str, on: list[str]) -> None:
    """Idempotent append: rows whose key the target already holds are left out.

    ``rows`` must hold each key once. Run again, it appends nothing. A null in a
    key equals a null.
    """
    spark = rows.sparkSession
    present = read_or_empty(spark, path, rows.schema).select(*[F.col(c).alias(f"_p_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & rows[c].eqNullSafe(present[f"_p_{c}"])
    rows.join(present, same, "left_anti").write.mode("append").parquet(path)


def write_flushes(emitted: DataFrame, path: str, flush: str = "flush_id") -> None:
    """Sorted events to a table: one folder per flush, replaced when written again.

    The sort leaves each stretch of a flush in one task, so nothing is shuffled
    here: a small flush is one file, a large one several, each of them sorted.
    """
    (
        emitted.sortWithinPartitions(flush, "pos", "partition")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(flush)
        .parquet(path)
    )


def read_flushes(spark: SparkSession, path: str, flush: str = "flush_id") -> DataFrame:
    """Flushed rows in delivery order; lanes that were sorted alone come interleaved."""
    return spark.read.parquet(path).orderBy(flush, "pos", "partition")
