import json

import pytest
from conftest import SF_DIR
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siftline.sources import batches, logs, positions as pos


def offsets(df):
    return sorted((r["partition"], r["offset"]) for r in df.collect())


@pytest.fixture
def names(log):
    return log((0, 3, "IBM"), (0, 5, "APPLE"), (0, 7, "MFST"))


def test_seek(names):
    assert offsets(pos.replay_from(names, {0: 5})) == [(0, 5), (0, 7)]


def test_seek_to_a_missing_offset(names):
    assert len(offsets(pos.start_at(names, {0: 10}, "earliest"))) == 3
    assert offsets(pos.start_at(names, {0: 10}, "latest")) == []
    with pytest.raises(pos.OffsetOutOfRange):
        pos.start_at(names, {0: 10}, "none")
    with pytest.raises(ValueError):
        pos.start_at(names, {0: 3}, "newest")


def test_end_of_log_and_gaps_are_in_range(names):
    assert offsets(pos.start_at(names, {0: 8}, "none")) == []
    assert offsets(pos.start_at(names, {0: 4}, "none")) == [(0, 5), (0, 7)]


def test_unknown_partition_follows_the_policy(names):
    with pytest.raises(pos.OffsetOutOfRange):
        pos.start_at(names, {4: 2}, "none")
    assert len(offsets(pos.start_at(names, {4: 2}, "earliest"))) == 3


def test_first_run_reads_everything_then_resumes(log):
    records = log((0, 1, "a"), (0, 4, "b"), (1, 2, "c"))
    assert offsets(pos.resume_after(records, {})) == offsets(records)
    assert pos.collect_positions(pos.last_positions(records)) == {0: 4, 1: 2}
    assert offsets(pos.resume_after(records, {0: 1})) == [(0, 4), (1, 2)]


def test_next_batch_is_bounded_and_never_stuck_in_a_gap(log):
    records = log((0, 1, "a"), (0, 2, "b"), (0, 50, "c"), (1, 7, "d"), (1, 9, "e"))
    assert offsets(pos.next_batch(records, {}, 2)) == [(0, 1), (0, 2), (1, 7)]
    assert offsets(pos.next_batch(records, {0: 2, 1: 7}, 2)) == [(0, 50), (1, 9)]
    assert offsets(pos.next_batch(records, {0: 50, 1: 9}, 2)) == []


def test_many_partitions_use_a_lookup(log):
    records = log(*[(p, o, "k") for p in range(80) for o in (1, 2)])
    starts = {p: 1 + p % 2 for p in range(79)}
    want = sorted((p, o) for p in range(80) for o in (1, 2) if o >= starts.get(p, 0))
    assert offsets(pos.replay_from(records, starts)) == want
    want = sorted((p, o) for p in range(79) for o in (1, 2) if o <= starts[p])
    assert offsets(pos.up_to(records, starts)) == want
    assert offsets(pos.up_to(records, {3: 1})) == [(3, 1)] and offsets(pos.up_to(records, {})) == []


def test_position_filter_reaches_the_scan(spark, log, tmp_path):
    path = str(tmp_path / "log")
    log((0, 1, "a"), (0, 4, "b"), (1, 2, "c")).write.parquet(path)
    plan = pos.resume_after(spark.read.parquet(path), {0: 1})._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(offset,2)" in pushed


def test_single_partition_guard(log):
    assert pos.assert_single_partition(log((0, 1, "a"))).count() == 1
    with pytest.raises(ValueError, match="one source partition"):
        pos.assert_single_partition(log((0, 1, "a"), (1, 1, "a")))


def test_batches_by_rank_not_by_offset(log):
    got = batches.assign_batches(log((0, 0, "a"), (0, 2, "b"), (0, 4, "c"), (0, 6, "d"), (1, 99, "e")), 2)
    assert sorted((r["partition"], r["offset"], r["batch_id"]) for r in got.collect()) == [
        (0, 0, 0), (0, 2, 0), (0, 4, 1), (0, 6, 1), (1, 99, 0),
    ]


def test_copies_of_a_record_share_a_batch(log):
    got = batches.assign_batches(log((0, 0, "a"), (0, 1, "b"), (0, 1, "b"), (0, 1, "b"), (0, 2, "c")), 2)
    assert sorted((r["offset"], r["batch_id"]) for r in got.collect()) == [(0, 0), (1, 0), (1, 0), (1, 0), (2, 1)]


PLACES = st.sets(st.tuples(st.integers(0, 2), st.integers(0, 60)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(places=PLACES, size=st.integers(1, 7))
def test_batches_agree_with_counting(log, places, size):
    want, seen = [], {}
    for p, o in sorted(places):
        want.append((p, o, seen.get(p, 0) // size))
        seen[p] = seen.get(p, 0) + 1
    got = batches.assign_batches(log(*[(p, o, "k") for p, o in places]), size)
    assert sorted((r["partition"], r["offset"], r["batch_id"]) for r in got.collect()) == want


def test_only_committed_batches_are_read(spark, log):
    rows = log((0, 0, "a"), (0, 1, "b"), (0, 2, "c")).withColumn("batch_id", F.col("offset"))
    done = spark.createDataFrame([(0,), (2,)], "batch_id bigint")
    assert offsets(batches.read_committed(rows, done)) == [(0, 0), (0, 2)]
    with pytest.raises(TypeError):
        batches.read_committed(rows, done.select(F.col("batch_id").cast("int")))


def test_kafka_options_carry_the_log_settings():
    options = logs.kafka_options("host:9092", "events", max_records=1000)
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert json.loads(pos.starting_offsets_json("events", {1: 7, 0: 3})) == {"events": {"0": 3, "1": 7}}


def test_kafka_columns_become_records(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("straße", "utf8"), "t", 1, 5)],
        "key binary, value binary, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    row = logs.kafka_records(raw).first()
    assert (row["partition"], row["offset"], row["key"], row["value"]) == (1, 5, "k", "straße")


def test_only_named_columns_are_scanned(spark):
    table = logs.read_table(spark, SF_DIR, "events")
    plan = logs.to_records(table, "event_id", "event_type", None)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_position_filter_reaches_the_scan_with_many_partitions(spark, log, tmp_path):
    path = str(tmp_path / "log")
    log(*[(p, o, "a") for p in range(200) for o in (1, 4, 9)]).write.parquet(path)
    committed = {p: 3 + p % 2 for p in range(200)}
    resumed = pos.resume_after(spark.read.parquet(path), committed)
    plan = resumed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,4)" in plan.split("PushedFilters: [")[1]
    assert offsets(resumed) == sorted((p, o) for p in range(200) for o in (1, 4, 9) if o > committed[p])


def test_no_partition_is_left_out_of_the_bounds(spark, log):
    records = log(*[(p, o, "a") for p in range(300) for o in (1, 2)])
    assert offsets(pos.start_at(records, {p: 99 for p in range(300)}, "latest")) == []
    assert len(offsets(pos.start_at(records, {p: 99 for p in range(300)}, "earliest"))) == 600
