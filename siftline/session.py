"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set session options for the duration of a block."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="siftline-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/siftline-{label}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    Later readers then see one fixed copy of the rows, also after an executor
    is lost.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
