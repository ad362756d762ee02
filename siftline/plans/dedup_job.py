"""Incremental dedup of a growing log with a durable registry table.

One run takes everything after the committed positions as one batch; the layout is
that of :mod:`siftline.sinks.ledger`. Nothing counts until the run's manifest is
written, so an aborted attempt leaves nothing behind and the next run repeats the
same batch id.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import guard_key
from ..operators.registry import rebuild
from ..schemas import REGISTRY
from ..sinks import ledger
from ..sinks.committed import KickoutHandler
from ..sinks.manifest import BUCKETS, LEASE_SECONDS, Manifest, newest, writing
from ..sources.positions import RESET_POLICIES, next_batch, resume_after, start_at


def micros(spark: SparkSession, time: datetime | str | Column) -> int:
    """A constant time in microseconds since 1970."""
    column = time if isinstance(time, Column) else F.lit(time)
    return spark.range(1).select(F.unix_micros(column.cast("timestamp"))).first()[0]


class DedupJob:
    """Dedup a log run by run; the state lives in files below ``root``.

    ``reset`` says what happens when a committed position is not in the log any more:
    ``none`` raises, ``earliest`` reads that source partition from its first record,
    ``latest`` skips the records it has now. Without it, whatever lies after the
    position is read, and nothing is checked. Only one run may write at a time; another one
    raises :class:`~siftline.sinks.manifest.WriterExists`. A run holds the root for
    ``lease_seconds``: after that, as when its driver was killed, the next run takes over, and the
    old one can no longer commit. ``buckets`` counts for a new root: choose it so that a
    bucket of the registry fits a task.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        scope: str = "topic",
        seen: str | None = None,
        on_null_key: str = "reject",
        on_kickouts: KickoutHandler | None = None,
        reset: str | None = None,
        buckets: int = BUCKETS,
        lease_seconds: float = LEASE_SECONDS,
    ):
        if reset is not None and reset not in RESET_POLICIES:
            raise ValueError(f"reset must be one of {RESET_POLICIES}")
        self._spark = spark
        self._root = root
        self._scope = scope
        self._seen = seen
        self._on_null_key = on_null_key
        self._on_kickouts = on_kickouts
        self._reset = reset
        self._buckets = buckets
        self._lease_seconds = lease_seconds

    @property
    def root(self) -> str:
        return self._root

    def _state(self) -> Manifest:
        return newest(self._spark, self._root)

    def _writing(self, take_over: bool = False):
        return writing(self._spark, self._root, self._buckets, self._lease_seconds, take_over)

    def positions(self) -> dict[int, int]:
        """Last committed offset per source partition: that of its newest batch."""
        return self._state().positions

    def commits(self) -> DataFrame:
        return ledger.commits(self._spark, self._root, self._state())

    def output(self, outcome: str = "unique") -> DataFrame:
        return ledger.output(self._spark, self._root, self._state(), outcome)

    def registry(self, as_of: int | None = None) -> DataFrame:
        """All committed entries, or those up to a batch: a restore point. Purged entries are in neither."""
        found = ledger.entries(self._spark, self._root, self._state(), as_of=as_of)
        return found.select(*REGISTRY.fieldNames())

    def compact(self) -> None:
        """Merge all pieces into one, and delete folders that no manifest names any more.

        Runs merge as they go, so this is not needed for the sake of speed. Readers of a state
        older than the newest one should be done before it.
        """
        with self._writing() as writer:
            if len(writer.current.pieces) > 1 or any(p.cutoff is not None for p in writer.current.pieces):
                ledger.merge(writer, writer.current.pieces)
            ledger.vacuum(writer, [])

    def purge(self, cutoff: datetime | str | Column) -> None:
        """Forget keys first seen before the cut-off, a constant: they count as new when they return.

        Nothing is rewritten; the rows go when their piece is merged.
        """
        with self._writing() as writer:
            writer.publish(pieces=ledger.forget(writer.current.pieces, micros(self._spark, cutoff)))

    def restore(self, entries: DataFrame, positions: dict[int, int]) -> None:
        """Start a new root from a backup or a rebuilt registry, and after the given positions."""
        with self._writing() as writer:
            if writer.current.pieces:
                raise ValueError(f"{self._root} has batches already")
            ledger.start(writer, entries, positions)

    def rebuild(self, log: DataFrame, positions: dict[int, int]) -> None:
        """Start a new root from the input log alone, as of the given positions."""
        seen = "first_seen" if self._seen is None else self._seen
        stamped = log if self._seen is not None else log.withColumn(seen, F.date_trunc("second", F.current_timestamp()))
        stamped = stamped.withColumn(seen, F.col(seen).cast("timestamp"))
        self.restore(rebuild(stamped, positions, self._scope, seen), positions)

    def run(self, log: DataFrame, max_offsets: int | None = None, take_over: bool = False) -> int | None:
        """Process what is new as one batch; its id, or None if there was nothing.

        ``max_offsets`` bounds the batch per source partition; call again for the rest. ``take_over``
        does not wait for the lease of a run that is known to be dead.
        """
        with self._writing(take_over) as writer:
            positions = writer.current.positions
            if self._reset is None:
                news = resume_after(log, positions)
            else:
                news = start_at(log, {p: o + 1 for p, o in positions.items()}, self._reset)
            if max_offsets is not None:
                news = next_batch(news, {}, max_offsets)
            fresh = guard_key(news, self._on_null_key)
            if fresh.isEmpty():
                return None
            seen = F.date_trunc("second", F.current_timestamp()) if self._seen is None else F.col(self._seen)
            batch_id = writer.current.batch + 1
            ledger.dedup_batch(
                writer, fresh, batch_id, self._scope, seen, self._reset is not None, self._on_kickouts
            )
            return batch_id
