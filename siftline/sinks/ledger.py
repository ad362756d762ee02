"""Batches of a root with manifests: registry entries by hash bucket, records, commit rows.

Layout below a root folder::

    manifest/v000000000012.json                              what counts, see siftline.sinks.manifest
    entries/piece=E-N/bucket=K/                              first-seen entries, sorted by key
    commits/piece=E-N/                                       one row per batch and source partition
    records/epoch=E/batch_id=N/outcome=unique|kickout|reject/ the flagged records

No folder is written twice: its name has the epoch of its writer. A batch is three
folders and then one manifest that names them, so whatever a run left behind that
did not get so far is never read. A batch begins as a piece of its own; FANOUT neighbours
of one level are merged into a piece of the next, so a root of n batches has some
FANOUT * log(n) pieces, and a run opens those of their buckets that its keys fall into.
"""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.dedup import first_positions, flag_records
from ..operators.registry import unregistered
from ..schemas import RECORD, REGISTRY
from ..session import settle
from ..sources.batches import read_committed
from ..sources.positions import collect_positions, up_to
from .committed import COMMIT, KickoutHandler, count_outcomes, write_outcomes
from .manifest import Manifest, Piece, Writer

FANOUT = 8

_ENTRY = T.StructType([*REGISTRY.fields, T.StructField("batch_id", T.LongType())])
_STORED_ENTRY = T.StructType([*_ENTRY.fields, T.StructField("piece", T.StringType()), T.StructField("bucket", T.IntegerType())])
LEDGER_COMMIT = T.StructType([*COMMIT.fields, T.StructField("epoch", T.LongType())])
_STORED_COMMIT = T.StructType([*LEDGER_COMMIT.fields, T.StructField("piece", T.StringType())])


def bucket_of(buckets: int) -> Column:
    """The bucket of a key, in either scope."""
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def _pieces(spark: SparkSession, root: str, folder: str, names: list[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    base = f"{root}/{folder}"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/piece={n}" for n in names])


def entries(
    spark: SparkSession, root: str, manifest: Manifest, buckets: list[int] | None = None, as_of: int | None = None
) -> DataFrame:
    """Registry entries, with ``batch_id``; of some buckets, whose folders alone are opened, or as of a batch."""
    parts = []
    pieces = [p for p in manifest.pieces if as_of is None or p.low <= as_of]
    for cutoff in {p.cutoff for p in pieces}:
        part = _pieces(spark, root, "entries", [p.name for p in pieces if p.cutoff == cutoff], _STORED_ENTRY)
        if cutoff is not None:
            part = part.where(F.col("first_seen") >= F.timestamp_micros(F.lit(cutoff)))
        parts.append(part)
    found = parts[0] if parts else spark.createDataFrame([], _STORED_ENTRY)
    for part in parts[1:]:
        found = found.unionByName(part)
    if buckets is not None and len(buckets) < manifest.buckets:
        found = found.where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
    if as_of is not None:
        found = found.where(F.col("batch_id") <= as_of)
    return found.select(*_ENTRY.fieldNames())


def commits(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """One row per committed batch and source partition."""
    return _pieces(spark, root, "commits", [p.name for p in manifest.pieces], _STORED_COMMIT).drop("piece")


def output(spark: SparkSession, root: str, manifest: Manifest, outcome: str = "unique") -> DataFrame:
    """Committed records of one outcome; delivery order is (partition, offset)."""
    done = commits(spark, root, manifest).where("n_in > 0")
    if done.isEmpty():
        # no batch yet, and so no other columns than those of a record
        return spark.createDataFrame([], T.StructType([*RECORD.fields, T.StructField("batch_id", T.LongType())]))
    rows = spark.read.parquet(f"{root}/records").where((F.col("outcome") == outcome) & (F.col("batch_id") <= manifest.batch))
    whole = rows.drop("outcome").withColumns({c: F.col(c).cast("bigint") for c in ("batch_id", "epoch")})
    return read_committed(whole, done, ["batch_id", "epoch"]).drop("epoch")


def write_entries(writer: Writer, rows: DataFrame, name: str) -> None:
    """Store entries, which have a ``batch_id``, by bucket and sorted by key: one file per bucket."""
    (
        rows.select(*_ENTRY.fieldNames(), bucket_of(writer.current.buckets).alias("bucket"))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key")
        .write.partitionBy("bucket")
        .parquet(f"{writer.root}/entries/piece={name}")
    )


def write_commits(writer: Writer, rows: DataFrame, name: str) -> None:
    rows.select(*LEDGER_COMMIT.fieldNames()).coalesce(1).write.parquet(f"{writer.root}/commits/piece={name}")


def start(writer: Writer, rows: DataFrame, positions: dict[int, int]) -> None:
    """Have a new root start from given entries and positions."""
    name = f"{writer.current.epoch}-start"
    write_entries(writer, rows.withColumn("batch_id", F.lit(-1).cast("bigint")), name)
    write_commits(writer, writer.spark.createDataFrame([], LEDGER_COMMIT), name)
    writer.publish(positions=dict(positions), pieces=(Piece(name, -1, -1),))


def forget(pieces: tuple[Piece, ...], cutoff: int) -> tuple[Piece, ...]:
    """The pieces without entries first seen before the cut-off, in microseconds; merging them drops the rows."""
    return tuple(p if p.cutoff is not None and p.cutoff >= cutoff else replace(p, cutoff=cutoff) for p in pieces)


def merge(writer: Writer, pieces: tuple[Piece, ...]) -> None:
    """Make one piece of neighbouring ones."""
    spark, root, current = writer.spark, writer.root, writer.current
    own = replace(current, pieces=pieces)
    name = f"{current.epoch}-{pieces[0].low}-{pieces[-1].high}-{current.version}"
    write_entries(writer, entries(spark, root, own), name)
    write_commits(writer, commits(spark, root, own), name)
    whole = Piece(name, pieces[0].low, pieces[-1].high, max(p.level for p in pieces) + 1)
    at = current.pieces.index(pieces[0])
    writer.publish(pieces=(*current.pieces[:at], whole, *current.pieces[at + len(pieces) :]))


def merge_due(writer: Writer) -> None:
    """Merge the newest pieces while FANOUT of them have one level."""
    while True:
        tail = writer.current.pieces[-FANOUT:]
        if len(tail) < FANOUT or len({p.level for p in tail}) > 1:
            return
        merge(writer, tail)


def delivered_again(rows: DataFrame, committed: dict[int, int]) -> DataFrame | None:
    """Positions that were committed before; None, the usual case, if there are none."""
    if not committed:
        return None
    old = up_to(rows, committed).select(F.col("offset").alias("first_offset"), "partition", "key")
    return None if old.isEmpty() else old


def dedup_batch(
    writer: Writer,
    rows: DataFrame,
    batch_id: int,
    scope: str,
    seen: Column,
    may_repeat: bool,
    on_kickouts: KickoutHandler | None = None,
    cutoff: int | None = None,
    streams: dict[str, int] | None = None,
) -> dict[int, int]:
    """Flag the rows against the registry and commit them as one batch; the positions reached.

    Only buckets that the batch has keys of are read. ``may_repeat`` says whether records can
    come that lie at or before a committed position; entries are then asked for theirs.
    """
    started = time.monotonic()
    spark, root, before = writer.spark, writer.root, writer.current
    known_pieces = before.pieces if cutoff is None else forget(before.pieces, cutoff)
    known_in = replace(before, pieces=known_pieces)
    name = f"{before.epoch}-{batch_id}"

    firsts = settle(first_positions(rows.withColumn("_seen", seen.cast("timestamp")), scope, "_seen"))
    buckets = [r[0] for r in firsts.select(bucket_of(before.buckets).alias("b")).distinct().collect()]
    known = entries(spark, root, known_in, buckets).select(*REGISTRY.fieldNames())
    added = unregistered(firsts, known, scope).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    write_entries(writer, added, name)
    # Earlier entries lie at or before the committed positions and the batch after
    # them, so only its own entries can be matched, unless records come again.
    marks = _pieces(spark, root, "entries", [name], _STORED_ENTRY).select("partition", "key", "first_offset")
    again = delivered_again(rows, before.positions) if may_repeat else None
    if again is not None:
        marks = marks.unionByName(known.drop("first_seen").join(again, ["first_offset", "partition", "key"], "left_semi"))

    written = write_outcomes(flag_records(rows, marks), f"{root}/records/epoch={before.epoch}/batch_id={batch_id}")
    counts = count_outcomes(written).persist()
    try:
        reached = collect_positions(counts.withColumnRenamed("committed_offset", "offset"))
        if not reached:
            return reached
        if on_kickouts is not None:
            on_kickouts(written.where("outcome = 'kickout'").drop("outcome"), batch_id)
        elapsed = int((time.monotonic() - started) * 1000)
        told = {"batch_id": batch_id, "epoch": before.epoch, "elapsed_ms": elapsed}
        write_commits(writer, counts.withColumns({c: F.lit(v).cast("bigint") for c, v in told.items()}), name)
    finally:
        counts.unpersist()
    writer.publish(
        batch=batch_id,
        positions={**before.positions, **reached},
        pieces=(*known_pieces, Piece(name, batch_id, batch_id)),
        streams=before.streams if streams is None else streams,
    )
    merge_due(writer)
    return reached


def vacuum(writer: Writer, manifests: list[Manifest]) -> int:
    """Delete folders of entries and commit rows that none of the manifests names; how many."""
    spark, root = writer.spark, writer.root
    named = {p.name for m in [*manifests, writer.current] for p in m.pieces}
    gone = 0
    for folder in ("entries", "commits"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(path) if files.exists(path) else []:
            if status.getPath().getName().removeprefix("piece=") not in named:
                files.delete(status.getPath(), True)
                gone += 1
    return gone
