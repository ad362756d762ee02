"""Keyed record logs as DataFrames: ``partition, offset, key, value`` (+ extras)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_records(
    table: DataFrame,
    offset: Column | str,
    key: Column | str | None,
    value: Column | str | None,
    partition: Column | str | int = 0,
    **extra: Column | str,
) -> DataFrame:
    """View any table as a record log. Only the named columns are read."""
    part = F.lit(partition) if isinstance(partition, int) else _col(partition)
    return table.select(
        part.cast("int").alias("partition"),
        _col(offset).cast("bigint").alias("offset"),
        (F.lit(None) if key is None else _col(key)).cast("string").alias("key"),
        (F.lit(None) if value is None else _col(value)).cast("string").alias("value"),
        *[_col(c).alias(name) for name, c in extra.items()],
    )


def read_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{directory}/{table}.parquet")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    glob: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Stream a folder of files, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_records: int | None = None,
    committed_only: bool = True,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of Spark's Kafka source; ``max_records`` bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.isolation.level": "read_committed" if committed_only else "read_uncommitted",
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def kafka_records(raw: DataFrame) -> DataFrame:
    """The record layout from the Kafka source's columns."""
    return raw.select(
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
    )


def stream_kafka(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Stream a Kafka topic; needs Spark's Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs)).load()
    return kafka_records(raw)
