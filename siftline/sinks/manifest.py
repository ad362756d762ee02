"""Numbered manifests: what a root holds is what its newest manifest names.

A manifest is a small file that is never overwritten. Whoever changes a root writes the
next number, which only one can: the file system must rename without replacing, as HDFS
does. So a change counts as a whole or not at all, and of two writers the one that
started from an older manifest is refused.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Older manifests than this many are deleted, which bounds what a reader lists.
KEEP = 32
LEASE_SECONDS = 3600.0
BUCKETS = 32


class WriterExists(RuntimeError):
    """Another run holds the root."""


class Fenced(WriterExists):
    """Another run has taken over the root; what this one did does not count."""


@dataclass(frozen=True)
class Piece:
    """Registry entries and commit rows of the batches ``low`` to ``high``, in folders of this name."""

    name: str
    low: int
    high: int
    level: int = 0
    # Entries first seen before this time, in microseconds, are forgotten.
    cutoff: int | None = None


@dataclass(frozen=True)
class Manifest:
    """The state of a root; ``version`` 0 is that of a root without any."""

    version: int = 0
    # Grows with every writer. The writer holds the root until ``lease``, in seconds, or until it lets go.
    epoch: int = 0
    lease: float | None = None
    batch: int = -1
    buckets: int = BUCKETS
    positions: dict[int, int] = field(default_factory=dict)
    pieces: tuple[Piece, ...] = ()
    # The last batch of each streaming query, by Spark's id for it.
    streams: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        raw["positions"] = {int(p): o for p, o in raw["positions"].items()}
        raw["pieces"] = tuple(Piece(**p) for p in raw["pieces"])
        return Manifest(**raw)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it; nothing happens if there is none."""
    at, files = _hadoop(spark, path)
    files.delete(at, True)


def _versions(spark: SparkSession, root: str) -> dict[int, str]:
    folder, files = _hadoop(spark, f"{root}/manifest")
    if not files.exists(folder):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return {int(n[1:-5]): n for n in names if n.startswith("v") and n.endswith(".json")}


def _read(spark: SparkSession, root: str, name: str) -> Manifest:
    path, files = _hadoop(spark, f"{root}/manifest/{name}")
    stream = files.open(path)
    try:
        return Manifest.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, root: str) -> Manifest:
    """The state of the root now."""
    found = _versions(spark, root)
    return _read(spark, root, found[max(found)]) if found else Manifest()


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make a manifest the newest one, unless its number is taken: then raise :class:`Fenced`."""
    attempt, files = _hadoop(spark, f"{root}/manifest/_{uuid.uuid4().hex}")
    out = files.create(attempt, False)
    out.write(bytearray(manifest.to_json().encode()))
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/v{manifest.version:012d}.json")
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(attempt, target, options)
    except Py4JJavaError as e:
        files.delete(attempt, False)
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            raise Fenced(f"{root} has a newer manifest than the one this run began with") from e
        raise
    for version, name in _versions(spark, root).items():
        if version <= manifest.version - KEEP:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/{name}"), False)


class Writer:
    """Holds a root for one run; every change goes on from the manifest it wrote last."""

    def __init__(self, spark: SparkSession, root: str, current: Manifest, lease_seconds: float):
        self.spark = spark
        self.root = root
        self.current = current
        self._lease_seconds = lease_seconds

    def publish(self, **changes) -> None:
        following = replace(self.current, version=self.current.version + 1, **changes)
        publish(self.spark, self.root, following)
        self.current = following

    def renew(self) -> None:
        """Hold the root for another term, and make sure that nobody has taken it over."""
        self.publish(lease=time.time() + self._lease_seconds)


@contextmanager
def writing(
    spark: SparkSession, root: str, buckets: int = BUCKETS, lease_seconds: float = LEASE_SECONDS, take_over: bool = False
) -> Iterator[Writer]:
    """Hold the root for the duration of a block, under the next epoch.

    While another writer's lease lasts, this raises :class:`WriterExists`. A lease that has run
    out, as after a killed driver, is taken over, with ``take_over`` also one that
    lasts. The other writer, should it still run, cannot commit any more.
    """
    before = newest(spark, root)
    if before.lease is not None and time.time() < before.lease and not take_over:
        raise WriterExists(f"{root} has a writer until {time.ctime(before.lease)}")
    if not before.version:
        before = replace(before, buckets=buckets)
    writer = Writer(spark, root, before, lease_seconds)
    writer.publish(epoch=before.epoch + 1, lease=time.time() + lease_seconds)
    try:
        yield writer
    finally:
        if writer.current.lease is not None:
            try:
                writer.publish(lease=None)
            except Fenced:
                # the root has another writer, and with it a lease that is not this one's to end
                pass


def release(spark: SparkSession, root: str) -> None:
    """Free a root at once whose writer was killed."""
    with writing(spark, root, take_over=True):
        pass
