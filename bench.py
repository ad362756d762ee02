"""Headline timings as one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Results go to the ``noop``
sink or to files, never through ``count()``. Each query runs once unmeasured and
then three times; the median counts. The tables are first written anew in FILES
files each, as a single small one would keep most cores idle. ``volume_*`` uses generated input in the
shape of a large-volume run: 10,000,000 records, 5 % of them repeats of 10,000
keys.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from siftline.operators import buffer as buf, dedup, registry as reg  # noqa: E402
from siftline.plans import catalog  # noqa: E402
from siftline.plans.dedup_job import DedupJob  # noqa: E402
from siftline.session import local_session, scratch_path  # noqa: E402
from siftline.sinks import committed as sink  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
VOLUME = int(os.environ.get("BENCH_VOLUME", "10000000"))
RUNS = 3
FILES = 16


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def in_files(spark: SparkSession) -> str:
    """The tables that the bench reads, each in FILES files."""
    folder = tempfile.mkdtemp(prefix="siftline-bench-")
    for name in ("events", "orders", "lineitem", "documents"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(FILES).write.parquet(f"{folder}/{name}.parquet")
    return folder


def volume_log(spark: SparkSession) -> DataFrame:
    """Repeats are spread over the whole run and hit the keys of its first records."""
    path = f"{tempfile.mkdtemp(prefix='siftline-bench-')}/volume"
    repeat = F.col("id") % 20 == 19
    (
        spark.range(0, VOLUME, 1, 16)
        .select(
            F.lit(0).alias("partition"),
            F.col("id").alias("offset"),
            F.concat(F.lit("key-"), F.when(repeat, F.col("id") % 10_000).otherwise(F.col("id"))).alias("key"),
            F.sha2(F.col("id").cast("string"), 256).alias("value"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def timed(run, runs: int = RUNS) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, int(CPUS)))
    tables = in_files(spark)
    log = catalog.event_log(spark, tables)
    hourly = catalog.event_rows(spark, tables).withColumn("flush_id", buf.flush_window("1 hour"))

    def job() -> None:
        DedupJob(spark, scratch_path(spark, "bench-job"), seen="ts").run(log)

    def flushes() -> None:
        daily = catalog.event_rows(spark, tables).withColumn("flush_id", F.date_trunc("day", "ts").cast("date"))
        sink.write_flushes(buf.buffer_and_sort(daily), scratch_path(spark, "bench-flush"))

    registry_path = scratch_path(spark, "bench-registry")
    reg.build_registry(log, seen="ts").write.parquet(registry_path)
    registry = spark.read.parquet(registry_path)

    queries = {
        "classify_events": lambda: noop(dedup.classify(log)),
        "keep_first_events": lambda: noop(dedup.keep_first(log)),
        "kickouts_events": lambda: noop(dedup.kickouts(dedup.classify(log))),
        "classify_against_registry": lambda: noop(dedup.classify(log, registry)),
        "classify_hot_keys_orders": lambda: noop(dedup.classify(catalog.order_log(spark, tables))),
        "keep_first_documents": lambda: noop(dedup.keep_first(catalog.document_log(spark, tables))),
        "compaction_events": lambda: noop(dedup.keep_latest(log)),
        "upsert_hourly": lambda: noop(buf.upsert(buf.prepare(hourly))),
        "sorted_flushes_hourly": lambda: noop(buf.buffer_and_sort(hourly)),
        "assign_batches": lambda: noop(catalog.s6_assign_batches(spark, tables)),
        "parse_event_json": lambda: noop(catalog.j1_parse_events(spark, tables)),
        "job_committed_output": job,
        "sorted_flushes_written": flushes,
    }
    seconds = {name: timed(run) for name, run in queries.items()}
    seconds["stream_classify_events"] = timed(lambda: catalog._run_dedup(spark, tables), 1)

    volume = volume_log(spark)
    seconds["volume_classify"] = timed(lambda: noop(dedup.classify(volume)), 1)
    seconds["volume_keep_first"] = timed(lambda: noop(dedup.keep_first(volume)), 1)

    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "files": FILES,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "volume_rows": VOLUME,
                "volume_rows_per_sec": round(VOLUME / seconds["volume_classify"]),
                "machine": f"{platform.machine()}, {os.cpu_count()} cores",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
