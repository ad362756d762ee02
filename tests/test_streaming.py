"""Streams, each checked against the batch form or the rules over the same rows."""

import glob
import os
import time
import uuid
from functools import partial
from datetime import datetime, timedelta

import model
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from siftline.operators import buffer as buf, registry as reg
from siftline.plans.dedup_job import DedupJob
from siftline.schemas import RECORD
from siftline.sinks import committed as sink, manifest
from siftline.sources import logs
from siftline.streaming import buffer as sbuf, control, dedup as sdedup, keyed_state as keyed, monitor, windows

EVENT_ROW = "partition int, offset bigint, eventType string, id string, payload string, ts timestamp"


class Folder:
    """A source folder that receives one file per call."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema
        os.makedirs(path)

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.path)
        time.sleep(0.01)

    def stream(self, max_files=1):
        return logs.stream_files(self.spark, self.path, self.schema, max_files, glob="*.parquet")


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, str(tmp_path / "in"), RECORD)


@pytest.fixture
def event_folder(spark, tmp_path):
    return Folder(spark, str(tmp_path / "events"), spark.createDataFrame([], EVENT_ROW).schema)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "state")


FORMS = {
    "counts": sdedup.start_dedup,
    "registry": partial(sdedup.start_dedup, known="registry"),
    "keyed": keyed.start_keyed_dedup,
}


@pytest.fixture(params=FORMS)
def run(request):
    """Run a stream to its end in each of the forms."""

    def go(folder, paths, max_files=1, **kwargs):
        return control.run_to_end(FORMS[request.param](folder.stream(max_files), *paths, **kwargs), 120)

    return go


def run_keyed(folder, paths, **kwargs):
    return control.run_to_end(keyed.start_keyed_dedup(folder.stream(), *paths, **kwargs), 120)


def has_ledger(root):
    return os.path.exists(f"{root}/manifest")


def read_output(spark, root, outcome="unique"):
    return DedupJob(spark, root).output(outcome) if has_ledger(root) else sink.read_output(spark, root, outcome)


def read_commits(spark, root):
    return DedupJob(spark, root).commits() if has_ledger(root) else sink.commits(spark, root)


def result(spark, root):
    out = {}
    for outcome in ("unique", "kickout", "reject"):
        rows = read_output(spark, root, outcome).collect()
        out[outcome] = sorted((r["offset"], r["value"]) for r in rows)
    return out


def test_lowest_offset_wins_inside_a_batch(spark, run, folder, paths):
    for low in (60, 40, 20, 0):
        folder.add(*[(0, o, f"k{o % 3}", str(o)) for o in range(low, low + 20)])
    run(folder, paths, max_files=None)
    assert result(spark, paths[0])["unique"] == [(0, "0"), (1, "1"), (2, "2")]
    assert len(result(spark, paths[0])["kickout"]) == 77


def test_late_lower_offset_and_replay_after_restart(spark, run, folder, paths):
    folder.add((0, 5, "k", "five"), (0, 7, "k", "seven"))
    run(folder, paths)
    folder.add((0, 3, "k", "three"), (0, 5, "k", "five again"), (0, 8, None, "none"))
    run(folder, paths)
    assert result(spark, paths[0]) == {
        "unique": [(5, "five"), (5, "five again")], "kickout": [(3, "three"), (7, "seven")], "reject": [(8, "none")],
    }


def test_registry_of_a_stream(spark, folder, paths):
    folder.add((0, 5, "k", "five"), (1, 2, "m", "two"))
    folder.add((0, 3, "k", "three"), (0, 6, "n", "six"))
    for start, state in ((sdedup.start_dedup, paths[1]), (keyed.start_keyed_dedup, f"{paths[1]}-keyed")):
        control.run_to_end(start(folder.stream(), f"{state}-out", state), 120)
    table = sink.read_registry(spark, f"{paths[1]}-out", upto=1)
    live = keyed.live_registry(spark, f"{paths[1]}-keyed")
    for registry in (table, live):
        got = sorted((r["key"], r["partition"], r["first_offset"]) for r in registry.collect())
        assert got == [("k", 0, 5), ("m", 1, 2), ("n", 0, 6)]
        assert registry.where("first_seen > current_timestamp() - interval 1 hour").count() == 3
    assert sink.read_registry(spark, f"{paths[1]}-out", upto=0).count() == 2


def test_crash_between_marker_and_checkpoint(spark, folder, paths, monkeypatch):
    """The batch is visible already when Spark runs it again."""
    folder.add((0, 0, "1", "1"), (0, 1, "2", "2"))
    folder.add((0, 2, "1", "1"), (0, 3, "3", "3"))
    real = sdedup.commit_batch

    def crash_after(flagged, root, batch_id, handler):
        reached = real(flagged, root, batch_id, handler)
        if batch_id == 1:
            raise RuntimeError("crash")
        return reached

    monkeypatch.setattr(sdedup, "commit_batch", crash_after)
    with pytest.raises(StreamingQueryException, match="crash"):
        control.run_to_end(sdedup.start_dedup(folder.stream(), *paths), 120)
    monkeypatch.setattr(sdedup, "commit_batch", real)
    want = {"unique": [(0, "1"), (1, "2"), (3, "3")], "kickout": [(2, "1")], "reject": []}
    assert result(spark, paths[0]) == want
    control.run_to_end(sdedup.start_dedup(folder.stream(), *paths), 120)
    assert result(spark, paths[0]) == want


def start_on_registry(folder, paths, **kwargs):
    return control.run_to_end(sdedup.start_dedup(folder.stream(), *paths, known="registry", **kwargs), 120)


@pytest.mark.parametrize("step", ["handler", "publish", "after"])
def test_a_registry_stream_crashes(spark, folder, paths, monkeypatch, step):
    """Before its manifest a batch is not there, and after it the replay changes nothing."""
    folder.add((0, 0, "1", "1"), (0, 1, "2", "2"))
    folder.add((0, 2, "1", "1"), (0, 3, "3", "3"))
    real = manifest.Writer.publish

    def crash(*_):
        raise RuntimeError("crash")

    def publish(self, **changes):
        if step == "publish" and changes.get("batch") == 1:
            crash()
        real(self, **changes)
        if step == "after" and changes.get("batch") == 1:
            crash()

    monkeypatch.setattr(manifest.Writer, "publish", publish)
    kwargs = {"on_kickouts": lambda rows, batch_id: batch_id == 1 and crash()} if step == "handler" else {}
    with pytest.raises(StreamingQueryException, match="crash"):
        start_on_registry(folder, paths, **kwargs)
    monkeypatch.undo()
    want = {"unique": [(0, "1"), (1, "2"), (3, "3")], "kickout": [(2, "1")], "reject": []}
    if step == "after":
        assert result(spark, paths[0]) == want
    else:
        assert result(spark, paths[0]) == {"unique": [(0, "1"), (1, "2")], "kickout": [], "reject": []}
    start_on_registry(folder, paths)
    assert result(spark, paths[0]) == want
    assert read_commits(spark, paths[0]).count() == 2


def test_registry_stream_reads_its_source_once(spark, folder, paths):
    folder.add((0, 0, "a", "a"), (0, 1, "b", "b"), (0, 2, "a", "a"))
    query = start_on_registry(folder, paths)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [3]


def test_registry_stream_purges_expires_and_goes_on_elsewhere(spark, folder, paths, tmp_path):
    folder.add((0, 0, "a", "a"), (0, 1, "b", "b"))
    start_on_registry(folder, paths)
    job = DedupJob(spark, paths[0])
    job.purge(F.current_timestamp() + F.expr("interval 1 hour"))
    assert job.registry().count() == 0
    folder.add((0, 2, "a", "a2"), (0, 3, "a", "a3"))
    start_on_registry(folder, paths)
    assert result(spark, paths[0]) == {"unique": [(0, "a"), (1, "b"), (2, "a2")], "kickout": [(3, "a3")], "reject": []}
    # another stream goes on from a backup of this one, and then its keys expire
    saved = str(tmp_path / "saved")
    reg.backup(job.registry(), saved, 1)
    later = Folder(spark, str(tmp_path / "later"), RECORD)
    fresh = f"{paths[0]}-2", f"{paths[1]}-2"
    DedupJob(spark, fresh[0]).restore(reg.restore(spark, saved, 1), job.positions())
    later.add((0, 4, "a", "a4"), (0, 5, "c", "c5"))
    start_on_registry(later, fresh)
    time.sleep(2)
    later.add((0, 6, "a", "a6"), (0, 7, "c", "c7"))
    start_on_registry(later, fresh, ttl_seconds=1)
    assert result(spark, fresh[0]) == {"unique": [(5, "c5"), (6, "a6"), (7, "c7")], "kickout": [(4, "a4")], "reject": []}


def test_two_streams_and_a_job_share_a_root(spark, folder, paths, log, tmp_path):
    """Each goes on from what the others left, whatever Spark's ids of its batches."""
    other = Folder(spark, str(tmp_path / "other"), RECORD)
    folder.add((0, 0, "a", "a"))
    start_on_registry(folder, paths)
    other.add((1, 0, "a", "a"), (1, 1, "b", "b"))
    start_on_registry(other, (paths[0], f"{paths[1]}-2"))
    assert DedupJob(spark, paths[0]).run(log((2, 0, "b"), (2, 1, "c"))) == 2
    folder.add((0, 1, "c", "c"), (0, 2, "d", "d"))
    start_on_registry(folder, paths)
    got = DedupJob(spark, paths[0])
    assert sorted((r["partition"], r["value"]) for r in got.output().collect()) == [(0, "a"), (0, "d"), (1, "b"), (2, "c")]
    assert got.output("kickout").count() == 3 and got.positions() == {0: 2, 1: 1, 2: 1}


def test_known_is_checked(folder, paths):
    for wrong in ({"known": "guess"}, {"ttl_seconds": 1}, {"seen": "ts"}):
        with pytest.raises(ValueError):
            sdedup.start_dedup(folder.stream(), *paths, **wrong)


def test_stream_agrees_with_the_model_over_many_batches(spark, run, folder, paths):
    rows = [(o % 2, o, f"k{(o * o) % 11}") for o in range(60)]
    known, want = {}, {}
    for start in range(0, 60, 15):
        batch = rows[start:start + 15]
        folder.add(*[(*r, r[2]) for r in batch])
        for scope in ("topic", "partition"):
            order = sorted(batch)
            for r, flag in zip(order, model.dedup(order, known.setdefault(scope, {}), scope)):
                want.setdefault(scope, {})[r[1]] = flag
    for scope in ("topic", "partition"):
        root, state = f"{paths[0]}-{scope}", f"{paths[1]}-{scope}"
        run(folder, (root, state), scope=scope)
        got = result(spark, root)
        flags = {o: False for o, _ in got["unique"]} | {o: True for o, _ in got["kickout"]}
        assert flags == want[scope]


def test_failed_batch_is_replayed(spark, run, folder, paths):
    folder.add((0, 0, "1", "1"), (0, 1, "2", "2"))
    folder.add((0, 2, "1", "1"), (0, 3, "3", "3"))
    reported = []

    def broken(_rows, batch_id):
        if batch_id == 1:
            raise RuntimeError("injected")

    with pytest.raises(StreamingQueryException, match="injected"):
        run(folder, paths, on_kickouts=broken)
    assert result(spark, paths[0]) == {"unique": [(0, "1"), (1, "2")], "kickout": [], "reject": []}
    run(folder, paths, on_kickouts=lambda df, _id: reported.extend(r["value"] for r in df.collect()))
    assert result(spark, paths[0])["unique"] == [(0, "1"), (1, "2"), (3, "3")]
    assert reported == ["1"]
    commits = read_commits(spark, paths[0]).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_in"], r["n_dup"], r["committed_offset"]) for r in commits] == [
        (0, 2, 0, 1), (1, 2, 1, 3),
    ]


def test_a_batch_without_rows_commits_nothing(spark, run, folder, paths):
    folder.add((0, 0, "a", "a"))
    spark.createDataFrame([], RECORD).coalesce(1).write.mode("append").parquet(folder.path)
    time.sleep(0.01)
    folder.add((0, 1, "b", "b"))
    run(folder, paths)
    ids = [r["batch_id"] for r in read_commits(spark, paths[0]).orderBy("batch_id").collect()]
    assert ids == ([0, 1] if has_ledger(paths[0]) else [0, 2])
    assert result(spark, paths[0])["unique"] == [(0, "a"), (1, "b")]


def test_restart_with_nothing_new(spark, run, folder, paths):
    folder.add((0, 0, "1", "1"), (0, 1, "2", "2"))
    run(folder, paths)
    run(folder, paths)
    assert read_commits(spark, paths[0]).count() == 1
    folder.add((0, 2, "3", "3"))
    run(folder, paths)
    last = read_commits(spark, paths[0]).agg(F.max("batch_id")).first()[0]
    newest = read_output(spark, paths[0]).where(F.col("batch_id") == last)
    assert [r["value"] for r in newest.collect()] == ["3"]


def test_batches_are_written_with_adaptive_execution(folder, paths):
    folder.add((0, 0, "a", "a"))
    plans = []

    def write(batch, _batch_id):
        plans.append(batch.groupBy("key").count()._jdf.queryExecution().executedPlan().toString())

    control.run_to_end(control.start_batches(folder.stream(), write, paths[1]), 60)
    assert len(plans) == 1 and "AdaptiveSparkPlan" in plans[0]


def test_null_key_can_fail_the_stream(run, folder, paths):
    folder.add((0, 0, None, "x"))
    with pytest.raises(StreamingQueryException, match="record without a key"):
        run(folder, paths, on_null_key="fail")


def test_backup_as_of_a_batch_and_restore(spark, folder, paths, tmp_path):
    folder.add((0, 0, "a", "a"), (0, 1, "b", "b"))
    folder.add((0, 2, "c", "c"))
    run_keyed(folder, paths)
    saved = str(tmp_path / "saved")
    reg.backup(keyed.live_registry(spark, paths[1], batch_id=0), saved, 0)
    backup = reg.restore(spark, saved, 0)
    assert sorted(r["key"] for r in backup.collect()) == ["a", "b"]

    later = Folder(spark, str(tmp_path / "later"), RECORD)
    later.add((0, 1, "b", "same"), (0, 7, "a", "again"), (0, 8, "c", "new"))
    fresh = f"{paths[0]}-2", f"{paths[1]}-2"
    run_keyed(later, fresh, restore=backup)
    assert result(spark, fresh[0]) == {"unique": [(1, "same"), (8, "new")], "kickout": [(7, "again")], "reject": []}


def test_only_one_writer_per_state(folder, paths):
    folder.add((0, 0, "a", "a"))
    first = sdedup.start_dedup(folder.stream(), *paths, interval="1 second")
    try:
        with pytest.raises(Exception, match="(?i)concurrent|already|active"):
            sdedup.start_dedup(folder.stream(), *paths, interval="1 second")
        assert first.isActive
    finally:
        first.stop()


def test_purged_key_is_new_again(spark, folder, paths):
    folder.add((0, 0, "a", "first"), (0, 1, "a", "dup"))
    query = keyed.start_keyed_dedup(folder.stream(), *paths, ttl_seconds=2, interval="500 milliseconds")

    def committed(n):
        return sink.commits(spark, paths[0]).count() >= n

    try:
        wait(lambda: committed(1), query)
        time.sleep(3)
        folder.add((0, 2, "a", "back"))
        wait(lambda: committed(2), query)
    finally:
        query.stop()
    got = result(spark, paths[0])
    assert got["unique"] == [(0, "first"), (2, "back")] and got["kickout"] == [(1, "dup")]


def wait(done, query, seconds=90):
    end = time.monotonic() + seconds
    while not done():
        assert query.isActive, query.exception()
        assert time.monotonic() < end, "took too long"
        time.sleep(0.2)


# ---- buffer and sort ------------------------------------------------------


def event(offset, kind, ident, payload, ts=None, partition=0):
    return (partition, offset, kind, ident, payload, ts or datetime(2024, 1, 1))


def flushes(spark, path, flush="flush_id"):
    out = {}
    for r in sink.read_flushes(spark, path, flush).collect():
        out.setdefault(r[flush], []).append((r["pos"], r["key"], r["eventType"], r["payload"]))
    return [out[f] for f in sorted(out)]


def test_wall_clock_flushes(spark, event_folder, paths):
    event_folder.add(event(0, "C", "1", "c"), event(1, "A", "1", "a"), event(2, "C", "1", "c2"), event(3, "A", None, "n"))
    query = sbuf.start_buffer_sort(event_folder.stream(), *paths, interval_seconds=2, trigger_interval="300 milliseconds")
    try:
        wait(lambda: sbuf.drained(query), query)
        event_folder.add(event(4, "B", "1", "b"), event(5, "STOP", "1", "s"), event(6, "START", "1", "t"))
        wait(lambda: len(glob.glob(f"{paths[0]}/flush_id=*")) == 2, query)
    finally:
        query.stop()
    assert flushes(spark, paths[0]) == [
        [(1, None, "A", "A"), (2, None, "A", "N"), (3, None, "C", "C2")],
        [(1, None, "B", "B"), (2, None, "START", "T"), (3, None, "STOP", "S")],
    ]


def test_trigger_flushes_and_crash(spark, event_folder, paths, monkeypatch):
    event_folder.add(event(0, "C", "1", "c"), event(1, "A", "1", "a"), event(2, "C", "1", "c2"))
    event_folder.add(event(3, "B", "1", "b"), event(4, "A", "1", "a2", partition=1))
    real = sbuf.write_flushes

    def crash_after(emitted, path):
        real(emitted, path)
        raise RuntimeError("crash")

    start = lambda: sbuf.start_trigger_sort(event_folder.stream(), *paths, interval=None, across_lanes=True)
    monkeypatch.setattr(sbuf, "write_flushes", crash_after)
    with pytest.raises(StreamingQueryException, match="crash"):
        control.run_to_end(start(), 120)
    monkeypatch.setattr(sbuf, "write_flushes", real)
    control.run_to_end(start(), 120)
    assert flushes(spark, paths[0]) == [
        [(1, None, "A", "A"), (2, None, "C", "C2")], [(1, None, "A", "A2"), (2, None, "B", "B")],
    ]


def test_buffer_survives_a_restart_and_can_be_looked_into(spark, event_folder, paths):
    interval = 15
    start = lambda: sbuf.start_buffer_sort(
        event_folder.stream(), *paths, interval_seconds=interval, trigger_interval="200 milliseconds"
    )
    query = start()
    wait(lambda: time.time() % interval < 1, query)  # a whole tick is left
    event_folder.add(event(0, "C", "1", "c"), event(1, "A", "1", "a"))
    wait(lambda: any(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators), query)
    time.sleep(1)  # let the batch commit, so that the restart finds nothing to repeat
    query.stop()
    held = sbuf.live_buffer(spark, paths[1])
    assert sorted((r["sort_key"], r["payload"]) for r in held.collect()) == [("A 1", "A"), ("C 1", "C")]
    again = start()
    try:
        wait(lambda: [s.numRowsTotal for p in again.recentProgress for s in p.stateOperators][-1:] == [0], again)
    finally:
        again.stop()
    assert flushes(spark, paths[0]) == [[(1, None, "A", "A"), (2, None, "C", "C")]]


def test_event_time_windows_and_late_rows(spark, event_folder, paths):
    t0 = datetime(2024, 1, 1)
    minute = timedelta(minutes=1)
    event_folder.add(event(0, "C", "1", "c", t0), event(1, "A", "1", "a", t0 + 5 * minute),
                     event(2, "C", "1", "c2", t0 + 6 * minute))
    event_folder.add(event(3, "B", "1", "b", t0 + 12 * minute), event(4, "A", "2", "x", t0 + 25 * minute))
    event_folder.add(event(5, "A", "4", "y", t0 + 26 * minute))
    event_folder.add(event(6, "A", "3", "late", t0 + 1 * minute), event(7, "A", "5", "z", t0 + 27 * minute))
    query = control.run_to_end(sbuf.start_window_sort(event_folder.stream(), *paths, "10 minutes"), 120)
    assert flushes(spark, paths[0], "flush_start") == [
        [(1, None, "A", "A"), (2, None, "C", "C2")], [(1, None, "B", "B")],
    ]
    progress = monitor.progress_table(spark, query)
    assert progress.agg(F.sum("late_rows")).first()[0] == 1
    batch = spark.read.parquet(event_folder.path).where("payload <> 'late'").withColumn(
        "flush_id", buf.flush_window("10 minutes"))
    closed = buf.closed(buf.upsert(buf.prepare(batch)), F.lit(t0 + 27 * minute), "10 minutes")
    assert closed.count() == 3 and buf.pending_size(buf.upsert(buf.prepare(batch)).subtract(closed)).first()[1] == 3


def test_split_windows_reject_late_untimed_and_bad_events(spark, event_folder, paths, monkeypatch):
    t0, minute = datetime(2024, 1, 1), timedelta(minutes=1)
    event_folder.add(event(0, "C", "1", "c", t0), event(1, "A", "1", "a", t0 + 5 * minute), event(2, "C", "1", "c2", t0 + 6 * minute))
    event_folder.add(event(3, "B", "1", "b", t0 + 12 * minute), event(4, "A", "2", "x", t0 + 25 * minute), (0, 5, "A", "2", "x", None))
    event_folder.add(event(6, "A", "3", "late", t0 + 1 * minute), event(7, None, "5", "z", t0 + 27 * minute), event(8, "A", "2", "y", t0 + 26 * minute))
    root, checkpoint = paths

    def start():
        return windows.start_window_split(event_folder.stream(), root, checkpoint, "10 minutes")

    # stopped before the mark of the second batch; the next run repeats the batch
    write, calls = windows.write_flushes, []

    def failing(*args):
        write(*args)
        calls.append(args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(windows, "write_flushes", failing)
    with pytest.raises(StreamingQueryException):
        control.run_to_end(start(), 120)
    assert calls and windows.marks(spark, root).count() == 1
    assert windows.rejects(spark, root).count() == 0
    monkeypatch.setattr(windows, "write_flushes", write)
    control.run_to_end(start(), 120)
    assert flushes(spark, f"{root}/flushes", "flush_start") == [[(1, None, "A", "A"), (2, None, "C", "C2")], [(1, None, "B", "B")]]
    assert sorted((r["offset"], r["reason"]) for r in windows.rejects(spark, root).collect()) == [(5, "untimed"), (6, "late"), (7, "missing type")]
    found = {r["outcome"]: r["n"] for r in windows.outcomes(spark, root).collect()}
    assert found == {"flushed": 3, "superseded": 1, "open": 2, "late": 1, "untimed": 1, "bad": 1}
    # pieces of windows flushed by an earlier batch are gone
    assert len(glob.glob(f"{root}/pieces/window=*")) == 1


# ---- reports --------------------------------------------------------------


def test_commit_log_state_report_and_console(spark, folder, paths, tmp_path):
    folder.add((0, 0, "a", "first value"), (0, 1, "b", "b"))
    folder.add((0, 2, "a", "a"))
    target, name = str(tmp_path / "commit_log"), f"q{uuid.uuid4().hex}"
    listener = monitor.CommitLog(spark, target, name)
    spark.streams.addListener(listener)
    try:
        rows = folder.stream().where("key is not null")
        query = (rows.writeStream.format("noop").queryName(name).option("checkpointLocation", paths[1])
                 .trigger(availableNow=True).start())
        control.run_to_end(query, 60)
        end = time.monotonic() + 30
        while sink.read_or_empty(spark, target, monitor.PROGRESS).where("input_rows > 0").count() < 2:
            assert time.monotonic() < end
            time.sleep(0.3)
    finally:
        spark.streams.removeListener(listener)
    logged = spark.read.parquet(target).where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r["name"], r["batch_id"], r["input_rows"]) for r in logged] == [(name, 0, 2), (name, 1, 1)]

    query = run_keyed(folder, (f"{paths[0]}-d", f"{paths[1]}-d"))
    report = monitor.state_report(spark, query).orderBy("batch_id").collect()
    assert [r["state_rows"] for r in report] == [2, 2] and all(r["partitions"] == 4 for r in report)

    printed = control.print_stream(folder.stream().select("value")).trigger(availableNow=True).start()
    control.run_to_end(printed, 60)
    assert printed.name == "output" and "Console" in printed.lastProgress.sink.description
    assert sum(p.sink.numOutputRows for p in printed.recentProgress) == 3


def test_restored_state_by_partition(spark, folder, paths):
    """Every state partition has a row, and a restart finds what the run before it left there."""
    folder.add(*[(0, o, f"k{o % 5}", "v") for o in range(20)])
    control.run_to_end(sdedup.start_dedup(folder.stream(), *paths), 120)
    found = monitor.restored_state(spark, paths[1]).collect()
    assert [r["partition"] for r in sorted(found)] == list(range(4))
    own = spark.range(5).selectExpr("pmod(hash(concat('k', id)), 4) AS p").groupBy("p").count().collect()
    assert {r["partition"]: r["entries"] for r in found if r["entries"]} == {r["p"]: r["count"] for r in own}
    assert {(r["operator"], r["state"], r["newest_batch"]) for r in found} == {("stateStoreSave", "default", 0)}
