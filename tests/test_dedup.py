import glob
import os
import re
from dataclasses import replace
from datetime import datetime

import model
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter, functions as F

from siftline.functions.keys import hashed_key, null_key_rejects, plain_key
from siftline.operators import dedup, registry as reg
from siftline.plans.dedup_job import DedupJob
from siftline.sinks import committed as sink, ledger, manifest


def flags(df):
    return sorted(((r["partition"], r["offset"], r["key"], r["is_duplicate"]) for r in df.collect()), key=repr)


def values(df):
    return [r["value"] for r in df.orderBy("partition", "offset").collect()]


def entries(registry):
    return {r["key"]: (r["partition"], r["first_offset"]) for r in registry.collect()}


def test_same_offset_is_no_duplicate(log):
    out = dedup.classify(log((0, 1, "k"), (0, 1, "k"), (0, 2, "k")))
    assert flags(out) == [(0, 1, "k", False), (0, 1, "k", False), (0, 2, "k", True)]


def test_replay_sequence(log):
    out = dedup.classify(log((0, 1, "KA"), (0, 2, "KB"), (0, 2, "KA"), (0, 1, "KA")))
    assert flags(out) == [
        (0, 1, "KA", False), (0, 1, "KA", False), (0, 2, "KA", True), (0, 2, "KB", False),
    ]


def test_registry_is_never_overwritten(log):
    known = dedup.first_positions(log((0, 5, "k")))
    out = dedup.classify(log((0, 3, "k"), (0, 5, "k")), known)
    assert flags(out) == [(0, 3, "k", True), (0, 5, "k", False)]
    assert entries(reg.extend_registry(known, log((0, 3, "k"), (0, 4, "m")))) == {"k": (0, 5), "m": (0, 4)}


def test_same_offset_in_two_partitions(log):
    records = log((0, 1, "k"), (1, 1, "k"))
    assert flags(dedup.classify(records)) == [(0, 1, "k", False), (1, 1, "k", True)]
    assert flags(dedup.classify(records, scope="partition")) == [(0, 1, "k", False), (1, 1, "k", False)]


def test_null_key_gets_no_verdict_and_is_rejected(log):
    records = log((0, 1, None, "a"), (0, 2, None, "b"), (0, 3, "k"))
    out = dedup.classify(records)
    assert flags(out) == [(0, 1, None, None), (0, 2, None, None), (0, 3, "k", False)]
    assert values(dedup.uniques(out)) == ["k"] and values(dedup.kickouts(out)) == []
    assert [r["reason"] for r in null_key_rejects(records).collect()] == ["null key"] * 2


def test_null_key_can_fail_the_batch(log):
    with pytest.raises(PySparkException, match="record without a key"):
        dedup.classify(log((0, 1, None)), on_null_key="fail").collect()


def test_keep_first_and_latest(log):
    records = log((0, 4, "a", "a4"), (0, 2, "a", "a2"), (0, 9, "a", "a9"), (0, 3, "b", "b3"), (0, 2, "a", "a2"))
    assert values(dedup.keep_first(records)) == ["a2", "b3"]
    assert values(dedup.keep_latest(records)) == ["b3", "a9"]
    assert dedup.keep_first(records).columns == records.columns


def test_scope_is_checked(log):
    with pytest.raises(ValueError):
        dedup.classify(log((0, 1, "k")), scope="cluster")


def test_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None)], "x string, y string")
    assert df.select(hashed_key("x", "y").alias("k")).distinct().count() == 3
    assert [r["k"] for r in df.select(plain_key("x", "y").alias("k")).collect()] == ["a bc", "ab c", None]


RECORDS = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 12), st.sampled_from(["a", "b", "c", "d", None])),
    min_size=1, max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=RECORDS, second=RECORDS, scope=st.sampled_from(dedup.SCOPES))
def test_two_batches_agree_with_the_model(log, first, second, scope):
    first, second = (sorted(b, key=lambda r: r[:2]) for b in (first, second))
    known = {}
    want_first, want_second = model.dedup(first, known, scope), None
    got_first = flags(dedup.classify(log(*first), scope=scope))
    assert got_first == sorted(((*r, f) for r, f in zip(first, want_first)), key=repr)
    want_second = model.dedup(second, known, scope)
    registry = reg.build_registry(log(*first), scope)
    got_second = flags(dedup.classify(log(*second), registry, scope))
    assert got_second == sorted(((*r, f) for r, f in zip(second, want_second)), key=repr)
    extended = reg.extend_registry(registry, log(*second), scope)
    got = {((r["key"] if scope == "topic" else (r["partition"], r["key"]))): (r["partition"], r["first_offset"])
           for r in extended.collect()}
    assert got == known


def test_volume_small(spark):
    """10,000 rows of which 5 % repeat one of 1,000 keys."""
    rows = spark.range(10_000).select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.when(F.col("id") >= 9_500, F.concat(F.lit("k"), F.col("id") % 1000))
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.lit("v").alias("value"),
    )
    counts = {r["is_duplicate"]: r["count"] for r in dedup.classify(rows).groupBy("is_duplicate").count().collect()}
    assert counts == {False: 9_500, True: 500}


# ---- registry -------------------------------------------------------------


def test_lookup_of_present_and_absent_keys(log):
    known = reg.build_registry(log((0, 3, "a"), (0, 7, "a"), (0, 4, "b")))
    asked = log((0, 0, "a"), (0, 0, "a"), (0, 0, "z")).select("key")
    got = sorted((r["key"], r["first_offset"]) for r in reg.lookup(asked, known).fillna(-1).collect())
    assert got == [("a", 3), ("a", 3), ("z", -1)]


def test_purged_key_is_new_again(log):
    records = log((0, 1, "old"), (0, 2, "new")).withColumn(
        "ts", F.when(F.col("key") == "old", F.lit(datetime(2024, 1, 1))).otherwise(F.lit(datetime(2024, 2, 1)))
    )
    kept = reg.purge(reg.build_registry(records, seen="ts"), datetime(2024, 1, 15))
    out = dedup.classify(log((0, 8, "old"), (0, 9, "new")), kept)
    assert flags(out) == [(0, 8, "old", False), (0, 9, "new", True)]


def test_rebuild_equals_the_lost_registry(log):
    records = log((0, 1, "a"), (0, 2, "b"), (1, 1, "c"), (0, 5, "a"), (1, 9, "late"))
    rebuilt = reg.rebuild(records, {0: 5, 1: 1})
    assert entries(rebuilt) == {"a": (0, 1), "b": (0, 2), "c": (1, 1)}
    output = log((0, 0, None, "a"), (0, 0, None, "x"), (0, 0, None, "c")).select("value")
    got = sorted((r["value"], r["side"]) for r in reg.check_rebuild(records, rebuilt, output).collect())
    assert got == [("b", "missing"), ("x", "unexpected")]


def test_backup_is_replaced_per_batch(spark, log, root):
    reg.backup(reg.build_registry(log((0, 1, "a"))), root, 3)
    reg.backup(reg.build_registry(log((0, 1, "a"), (0, 2, "b"))), root, 3)
    reg.backup(reg.build_registry(log((0, 1, "a"))), root, 4)
    assert set(entries(reg.restore(spark, root, 3))) == {"a", "b"}
    assert set(entries(reg.restore(spark, root, 4))) == {"a"}


def test_append_is_idempotent(spark, log, root):
    sink.append_new(log((0, 1, "a"), (0, 2, "b")), root, ["key"])
    sink.append_new(log((0, 1, "a"), (0, 2, "b"), (0, 3, "c")), root, ["key"])
    assert values(spark.read.parquet(root)) == ["a", "b", "c"]


# ---- the incremental job --------------------------------------------------


def test_happy_path_with_restart(spark, log, root):
    rows = [(0, 0, "1"), (0, 2, "2"), (0, 4, "2"), (0, 6, "7")]
    assert DedupJob(spark, root).run(log(*rows)) == 0
    job = DedupJob(spark, root)
    assert values(job.output()) == ["1", "2", "7"] and values(job.output("kickout")) == ["2"]
    assert job.positions() == {0: 6}
    assert job.run(log(*rows, (0, 8, "3"))) == 1
    assert values(job.output()) == ["1", "2", "7", "3"]
    assert values(job.output().where("batch_id = 1")) == ["3"]


def test_batches_full_of_kickouts(spark, log, root):
    rows = [(0, o, k) for o, k in enumerate("11231143")]
    job = DedupJob(spark, root)
    while job.run(log(*rows), max_offsets=2) is not None:
        pass
    assert values(job.output()) == ["1", "2", "3", "4"]
    assert values(job.output("kickout")) == ["1", "1", "1", "3"]
    got = [tuple(r) for r in job.commits().orderBy("batch_id")
           .select("batch_id", "n_in", "n_unique", "n_dup", "n_reject", "committed_offset").collect()]
    assert got == [(0, 2, 1, 1, 0, 1), (1, 2, 2, 0, 0, 3), (2, 2, 0, 2, 0, 5), (3, 2, 1, 1, 0, 7)]


def test_resume_with_nothing_new_commits_nothing(spark, log, root):
    rows = [(0, 0, "1"), (0, 1, "2")]
    job = DedupJob(spark, root)
    job.run(log(*rows))
    assert job.run(log(*rows)) is None
    assert job.commits().count() == 1
    job.run(log(*rows, (0, 2, "3")))
    assert values(job.output().where("batch_id = 1")) == ["3"]


def test_failed_batch_is_repeated_without_loss_or_repeat(spark, log, root):
    rows = [(0, 0, "1"), (0, 1, "2"), (0, 2, "1"), (0, 3, "3")]
    DedupJob(spark, root).run(log(*rows[:2]))
    reported = []

    def broken(_rows, _batch_id):
        raise RuntimeError("injected")

    with pytest.raises(RuntimeError, match="injected"):
        DedupJob(spark, root, on_kickouts=broken).run(log(*rows))
    job = DedupJob(spark, root, on_kickouts=lambda df, _id: reported.extend(values(df)))
    assert values(job.output()) == ["1", "2"] and job.positions() == {0: 1}
    assert set(entries(job.registry())) == {"1", "2"}
    assert job.run(log(*rows)) == 1
    assert values(job.output()) == ["1", "2", "3"] and reported == ["1"]
    assert set(entries(job.registry())) == {"1", "2", "3"}
    assert set(entries(job.registry(as_of=0))) == {"1", "2"}


def test_job_rejects_null_keys_and_moves_on(spark, log, root):
    job = DedupJob(spark, root)
    job.run(log((0, 0, None, "x"), (0, 1, "a"), (1, 5, "a")))
    assert values(job.output()) == ["a"] and values(job.output("reject")) == ["x"]
    assert job.positions() == {0: 1, 1: 5}


def test_job_can_be_scoped_to_partitions(spark, log, root):
    job = DedupJob(spark, root, scope="partition")
    job.run(log((0, 1, "k"), (1, 1, "k")))
    job.run(log((0, 1, "k"), (1, 1, "k"), (0, 2, "k"), (2, 2, "k")))
    assert [tuple(r) for r in job.output().select("partition", "offset").orderBy("partition").collect()] == [
        (0, 1), (1, 1), (2, 2),
    ]


def test_a_failed_attempt_leaves_nothing_under_dynamic_overwrite(spark, log, root):
    from siftline.session import session_conf
    from siftline.sinks import committed as sink

    def fail(rows, batch_id):
        raise RuntimeError("no")

    first = log((0, 1, "a"), (0, 2, None)).selectExpr("*", "IF(key IS NULL, NULL, false) AS is_duplicate")
    again = log((0, 1, "a")).selectExpr("*", "false AS is_duplicate")
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        with pytest.raises(RuntimeError):
            sink.commit_batch(first, root, 0, fail)
        assert sink.read_output(spark, root).count() == 0
        sink.commit_batch(again, root, 0)
    assert sink.read_output(spark, root, "reject").count() == 0
    assert [r["n_in"] for r in sink.commits(spark, root).collect()] == [1]


def test_a_second_writer_is_refused_and_harms_nothing(spark, log, root):
    from siftline.sinks.manifest import WriterExists, release, writing

    refused = []

    def overlap(_rows, _batch_id):
        with pytest.raises(WriterExists):
            DedupJob(spark, root).run(log((0, 0, "a"), (0, 1, "a"), (0, 2, "z")))
        refused.append(True)

    job = DedupJob(spark, root, on_kickouts=overlap)
    assert job.run(log((0, 0, "a"), (0, 1, "a"))) == 0 and refused == [True]
    assert values(job.output()) == ["a"]
    assert DedupJob(spark, root).run(log((0, 2, "b"))) == 1
    killed = writing(spark, root)
    killed.__enter__()
    with pytest.raises(WriterExists):
        DedupJob(spark, root).run(log((0, 3, "c")))
    assert DedupJob(spark, root).run(log((0, 3, "c")), take_over=True) == 2
    killed = writing(spark, root)
    killed.__enter__()
    release(spark, root)
    assert DedupJob(spark, root).run(log((0, 4, "d"))) == 3


def test_reset_policies_of_the_job(spark, log, root):
    from siftline.sources.positions import OffsetOutOfRange

    DedupJob(spark, root).run(log((0, 0, "a"), (0, 1, "b")))
    cut = log((0, 5, "a"), (0, 6, "c"))
    with pytest.raises(OffsetOutOfRange):
        DedupJob(spark, root, reset="none").run(cut)
    assert DedupJob(spark, root, reset="latest").run(cut) is None
    assert DedupJob(spark, root, reset="earliest").run(cut, max_offsets=1) == 1
    job = DedupJob(spark, root, reset="earliest")
    assert job.run(cut) == 2 and job.run(cut) is None
    assert values(job.output()) == ["a", "b", "c"] and values(job.output("kickout")) == ["a"]
    # a log that was made anew: what stands at its registered position passes again
    anew = log((0, 0, "a"), (0, 1, "d"))
    assert job.run(anew) == 3 and job.positions() == {0: 1}
    assert job.run(anew) is None
    assert values(job.output().where("batch_id = 3")) == ["a", "d"]
    with pytest.raises(ValueError):
        DedupJob(spark, root, reset="sometimes")


def test_compaction(spark, log, root):
    rows = [(0, o, k) for o, k in enumerate("abcad")]
    job = DedupJob(spark, root)
    while job.run(log(*rows), max_offsets=1) is not None:
        pass
    before = entries(job.registry())
    job.compact()
    job.compact()
    assert len(manifest.newest(spark, root).pieces) == 1
    assert len(os.listdir(f"{root}/entries")) == len(os.listdir(f"{root}/commits")) == 1
    assert entries(job.registry()) == before and job.positions() == {0: 4}
    assert set(entries(job.registry(as_of=1))) == {"a", "b"}
    assert job.run(log(*rows, (0, 5, "b"), (0, 6, "e"))) == 5
    assert values(job.output().where("batch_id = 5")) == ["e"]
    assert set(entries(job.registry())) == {"a", "b", "c", "d", "e"}
    assert job.commits().count() == 6 and job.output().count() == 5


def test_runs_merge_as_they_go(spark, log, root, monkeypatch):
    monkeypatch.setattr(ledger, "FANOUT", 2)
    rows = [(0, o, k) for o, k in enumerate("abcadbe")]
    job = DedupJob(spark, root, buckets=3)
    while job.run(log(*rows), max_offsets=1) is not None:
        pass
    pieces = manifest.newest(spark, root).pieces
    assert [(p.low, p.high, p.level) for p in pieces] == [(0, 3, 2), (4, 5, 1), (6, 6, 0)]
    assert values(job.output()) == ["a", "b", "c", "d", "e"] and values(job.output("kickout")) == ["a", "b"]
    assert entries(job.registry()) == {"a": (0, 0), "b": (0, 1), "c": (0, 2), "d": (0, 4), "e": (0, 6)}
    assert set(entries(job.registry(as_of=1))) == {"a", "b"}
    assert sorted(r["batch_id"] for r in job.commits().collect()) == list(range(7))


def test_ten_thousand_batches_have_few_pieces(monkeypatch):
    class Kept:
        spark = root = None
        current = manifest.Manifest(version=1, epoch=1)

        def publish(self, **changes):
            self.current = replace(self.current, version=self.current.version + 1, **changes)

    for name in ("write_entries", "write_commits", "entries", "commits"):
        monkeypatch.setattr(ledger, name, lambda *_: None)
    kept, most = Kept(), 0
    for batch in range(10_000):
        kept.publish(batch=batch, pieces=(*kept.current.pieces, manifest.Piece(f"1-{batch}", batch, batch)))
        ledger.merge_due(kept)
        most = max(most, len(kept.current.pieces))
    spans = [(p.low, p.high) for p in kept.current.pieces]
    assert spans[0][0] == 0 and spans[-1][1] == 9_999
    assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert most <= 5 * ledger.FANOUT and len(kept.current.to_json()) < 10_000


def test_a_run_opens_the_buckets_of_its_keys(spark, log, root):
    many = spark.range(5_000).selectExpr("0 AS partition", "id AS offset", "concat('k', id) AS key", "'v' AS value")
    job = DedupJob(spark, root, buckets=512)
    job.run(many)
    state = manifest.newest(spark, root)
    keys = log(*[(0, 5_000 + i, f"k{i * 7}") for i in range(100)])
    wanted = [r[0] for r in keys.select(ledger.bucket_of(512)).distinct().collect()]
    assert len(wanted) <= 100
    found = ledger.entries(spark, root, state, wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|INSET)", plan)
    opened = found.select(F.regexp_extract(F.input_file_name(), "bucket=(\\d+)", 1).cast("int")).distinct().collect()
    assert {r[0] for r in opened} == set(wanted)
    # sorted by key, and one file per bucket
    files = glob.glob(f"{root}/entries/piece=*/bucket={wanted[0]}/*.parquet")
    assert len(files) == 1
    held = [r["key"] for r in spark.read.parquet(files[0]).collect()]
    assert held == sorted(held) and len(held) > 1
    assert job.run(many.unionByName(keys)) == 1
    assert job.output("kickout").count() == 100


def test_a_crash_at_any_write_leaves_the_state_before_or_after(spark, log, root, monkeypatch):
    """Every write of a run, a purge and a compaction fails in turn; each is then done again."""
    monkeypatch.setattr(ledger, "FANOUT", 2)
    rows = [(0, o, k) for o, k in enumerate("abcadbeacf")]
    job = DedupJob(spark, root, buckets=2, seen="ts")

    def stamped(n):
        return log(*rows[:n]).withColumn("ts", F.timestamp_seconds(F.col("offset")))

    def state():
        done = [sorted((r["offset"], r["batch_id"]) for r in job.output(o).collect()) for o in ("unique", "kickout")]
        return entries(job.registry()), job.positions(), done

    class Crash(RuntimeError):
        pass

    def fails_at(n, act):
        """Whether the n-th write came; it did not happen."""
        left = [n]

        def counted(real):
            def write(*args, **kwargs):
                left[0] -= 1
                if left[0] == 0:
                    raise Crash
                return real(*args, **kwargs)

            return write

        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", counted(DataFrameWriter.parquet))
            m.setattr(manifest, "publish", counted(manifest.publish))
            try:
                act()
            except Crash:
                return True
        return False

    acts = [
        lambda: job.run(stamped(3)),
        lambda: job.run(stamped(6)),
        job.compact,
        lambda: job.purge(F.timestamp_seconds(F.lit(2))),
        lambda: job.purge(F.timestamp_seconds(F.lit(3))),
        lambda: job.run(stamped(10)),
        job.compact,
    ]
    crashes = 0
    for act in acts:
        before, seen, n = state(), [], 1
        while fails_at(n, act):
            manifest.release(spark, root)
            seen.append(state())
            crashes += 1
            n += 1
            if seen[-1] != before:
                # it counted already, and only what follows it was lost
                break
        else:
            seen.append(state())
        assert all(s == before for s in seen[:-1])
    assert crashes > 20
    want = model_of_the_acts()
    assert state() == want


def model_of_the_acts():
    """The keys a to f of the log: a, b, c first; a purge of a, b; and a purge of c."""
    unique = [(0, 0), (1, 0), (2, 0), (4, 1), (6, 2), (7, 2), (8, 2), (9, 2)]
    kickout = [(3, 1), (5, 1)]
    return {"d": (0, 4), "e": (0, 6), "a": (0, 7), "c": (0, 8), "f": (0, 9)}, {0: 9}, [unique, kickout]


def test_a_run_takes_over_from_a_dead_one(spark, log, root):
    """The lease of the first run is over before it commits; its late commit is refused."""
    later = DedupJob(spark, root)

    def overtaken(_rows, _batch_id):
        assert later.run(log((0, 0, "a"), (0, 1, "a"), (0, 2, "z"))) == 0

    slow = DedupJob(spark, root, on_kickouts=overtaken, lease_seconds=0)
    with pytest.raises(manifest.Fenced):
        slow.run(log((0, 0, "a"), (0, 1, "a")))
    assert values(later.output()) == ["a", "z"] and values(later.output("kickout")) == ["a"]
    assert later.positions() == {0: 2} and later.commits().count() == 1
    assert manifest.newest(spark, root).lease is None
    assert later.run(log((0, 3, "a"))) == 1


def test_old_manifests_go(spark, root, monkeypatch):
    monkeypatch.setattr(manifest, "KEEP", 3)
    for n in range(5):
        with manifest.writing(spark, root) as writer:
            writer.renew()
            assert writer.current.epoch == n + 1
    assert len([f for f in os.listdir(f"{root}/manifest") if f.startswith("v")]) == 3
    assert not [f for f in os.listdir(f"{root}/manifest") if f.startswith("_")]


def test_restore_and_rebuild_into_a_new_root(spark, log, root):
    rows = [(0, 0, "a"), (0, 1, "b"), (0, 2, "a")]
    old = DedupJob(spark, f"{root}-old")
    old.run(log(*rows))
    reg.backup(old.registry(), f"{root}-backup", 0)
    restored, rebuilt = DedupJob(spark, f"{root}-1"), DedupJob(spark, f"{root}-2")
    restored.restore(reg.restore(spark, f"{root}-backup", 0), old.positions())
    rebuilt.rebuild(log(*rows), old.positions())
    for job in (restored, rebuilt):
        assert job.output().count() == 0 and job.positions() == {0: 2}
        assert entries(job.registry()) == entries(old.registry())
        assert job.run(log(*rows, (0, 3, "b"), (0, 4, "c"))) == 0
        assert values(job.output()) == ["c"] and values(job.output("kickout")) == ["b"]
        with pytest.raises(ValueError):
            job.restore(old.registry(), {})
