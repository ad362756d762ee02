from datetime import datetime

import model
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siftline.operators import buffer as buf, joins, ranking
from siftline.plans.sort_job import sort_log
from siftline.sinks import committed as sink

SCHEMA = "flush_id bigint, partition int, offset bigint, eventType string, id string, payload string"


def make(spark, *events, flush=0, partition=0):
    rows = [(flush, partition, i, *e) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, SCHEMA)


def sent(emitted, flush=0):
    rows = emitted.where(F.col("flush_id") == flush).orderBy("partition", "pos").collect()
    return [(r["eventType"], r["id"], r["payload"]) for r in rows]


def test_buffer_sort(spark):
    events = make(spark, ("C", "9", "see"), ("A", "8", "ay"))
    buffered = buf.upsert(buf.prepare(events))
    assert buf.peek(buffered, "C 9").first()["payload"] == "SEE"
    assert buf.pending_size(buffered).first()["n_pending"] == 2
    out = buf.buffer_and_sort(events)
    assert sent(out) == [("A", "8", "AY"), ("C", "9", "SEE")]
    assert out.where("key is not null").count() == 0


def test_later_event_replaces_earlier(spark):
    assert sent(buf.buffer_and_sort(make(spark, ("C", "1", "a"), ("C", "1", "b")))) == [("C", "1", "B")]


def test_buffer_boundary(spark):
    events = make(spark, ("C", "1", "c")).unionByName(make(spark, ("A", "1", "a"), flush=1))
    out = buf.buffer_and_sort(events)
    assert sent(out, 0) == [("C", "1", "C")] and sent(out, 1) == [("A", "1", "A")]


def test_order_is_by_text(spark):
    got = sent(buf.buffer_and_sort(make(spark, *[(t, "1", "x") for t in ("START", "STOP", "A", "P")])))
    assert [t for t, _, _ in got] == ["A", "P", "START", "STOP"]


def test_reverse_types(spark):
    got = sent(buf.buffer_and_sort(make(spark, *[(t, str(i), "x") for i, t in enumerate("PONMLKJIHGFEDCBA")])))
    assert [t for t, _, _ in got] == list("ABCDEFGHIJKLMNOP")


def test_null_id_sorts_as_text(spark):
    got = sent(buf.buffer_and_sort(make(spark, ("A", "z", "x"), ("A", None, "y"), ("A", "a", "z"))))
    assert [i for _, i, _ in got] == ["a", None, "z"]


def test_lanes_sort_alone_or_together(spark):
    events = make(spark, ("C", "1", "c"), ("A", "1", "a")).unionByName(
        make(spark, ("B", "1", "b"), ("A", "1", "a2"), partition=1)
    )
    assert [p for _, _, p in sent(buf.buffer_and_sort(events))] == ["A", "C", "A2", "B"]
    merged = buf.buffer_and_sort(events, across_lanes=True).orderBy("pos").collect()
    assert [(r["pos"], r["payload"]) for r in merged] == [(1, "A"), (2, "A2"), (3, "B"), (4, "C")]


def test_closed_and_pending_windows(spark):
    rows = spark.createDataFrame(
        [(0, 0, datetime(2024, 1, 1, 0, 59)), (0, 1, datetime(2024, 1, 1, 1, 0)), (0, 2, datetime(2024, 1, 1, 2, 1))],
        "partition int, offset bigint, ts timestamp",
    ).withColumn("flush_id", buf.flush_window("1 hour"))
    mark = F.lit(datetime(2024, 1, 1, 2, 0))
    assert [r["offset"] for r in buf.closed(rows, mark, "1 hour").orderBy("offset").collect()] == [0, 1]
    assert [r["offset"] for r in buf.pending(rows, mark, "1 hour").collect()] == [2]


EVENTS = st.lists(
    st.tuples(st.sampled_from(["START", "A", "B", "STOP"]), st.sampled_from(["1", "10", "2", "ß", None]),
              st.text("abß", min_size=1, max_size=3)),
    min_size=1, max_size=20,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=EVENTS)
def test_flush_agrees_with_the_model(spark, events):
    assert sent(buf.buffer_and_sort(make(spark, *events))) == model.flush(events)


ROWS = st.sets(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 40)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, broadcast=st.booleans())
def test_positions_agree_with_counting(spark, rows, broadcast):
    limit = joins.BROADCAST_BYTES
    joins.BROADCAST_BYTES = limit if broadcast else 0
    try:
        df = spark.createDataFrame(list(rows), "g string, o int")
        got = {(r["g"], r["o"]): r["pos"] for r in ranking.with_position(df, ["g"], ["o"]).collect()}
    finally:
        joins.BROADCAST_BYTES = limit
    assert got == {(g, o): 1 + sum(1 for h, p in rows if h == g and p < o) for g, o in rows}


def test_sort_job_writes_flushes_and_rejects(spark, tmp_path):
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    log = spark.createDataFrame(
        [(0, 0, '{"eventType":"C","id":"1","payload":"c"}', 0), (0, 1, '{"eventType":"A","id":"1","payload":"a"}', 0),
         (0, 2, "{bad", 0), (0, 3, '{"eventType":"B","id":"1","payload":"b"}', 1)],
        "partition int, offset bigint, value string, batch bigint",
    )
    for _ in range(2):
        sort_log(log, F.col("batch"), out, bad)
    rows = [(r["flush_id"], r["pos"], r["payload"]) for r in sink.read_flushes(spark, out).collect()]
    assert rows == [(0, 1, "A"), (0, 2, "C"), (1, 1, "B")]
    assert [(r["offset"], r["reason"]) for r in spark.read.parquet(bad).collect()] == [(2, "malformed json")]


def test_events_without_type_payload_or_time_are_not_lost(spark, tmp_path):
    from siftline.operators import buffer as buf
    from siftline.plans.sort_job import sort_log
    from siftline.sinks.committed import read_flushes

    rows = [(0, 1, None, "1", "a"), (0, 2, None, "2", "b"), (0, 3, "A", "1", None), (0, 4, "A", "2", "c")]
    events = spark.createDataFrame(rows, "partition int, offset long, eventType string, id string, payload string")
    events = events.selectExpr("*", "1L AS flush_id")
    with pytest.raises(Exception, match="missing (type|payload)"):
        buf.buffer_and_sort(events).collect()
    assert buf.buffer_and_sort(events, on_bad_event="reject").count() == 1
    assert [r["reason"] for r in buf.bad_events(events).orderBy("offset").collect()] == ["missing type"] * 2 + ["missing payload"]

    good, path, rejects = '{"eventType":"A","id":"1","payload":"x"}', str(tmp_path / "out"), str(tmp_path / "rejects")
    log = spark.createDataFrame([(0, 1, None, good, "2024-01-01 00:10:00"), (0, 2, None, good, None), (0, 3, None, "{bad", None)], "partition int, offset long, key string, value string, at string")
    sort_log(log.selectExpr("*", "CAST(at AS timestamp) AS ts"), buf.flush_window("1 hour"), path, rejects)
    assert read_flushes(spark, path).count() == 1
    assert sorted(r["reason"] for r in spark.read.parquet(rejects).collect()) == ["malformed json", "missing time"]


def test_windows_have_a_fixed_length():
    for interval in ("1 month", "2 YEARS", "1 quarter"):
        with pytest.raises(ValueError, match="date_trunc"):
            buf.flush_window(interval)
    buf.flush_window("90 minutes")
