"""Plans and row distribution: what must hold when the data is large and skewed."""

import glob

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from siftline.operators import buffer as buf, dedup, joins, ranking, registry as reg
from siftline.plans import catalog
from siftline.session import session_conf, settle
from siftline.sinks import committed as sink
from siftline.sources import batches

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
FIXED_PLAN = {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}
SPLIT_EARLY = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_log(spark):
    """30,000 records, a third of them with one key."""
    return spark.range(0, 30_000, 1, 4).select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )


def test_a_hot_key_is_spread_over_all_tasks(spark, hot_log):
    with session_conf(spark, FIXED_PLAN):
        flagged = dedup.classify(hot_log)
        shares = [r["count"] for r in flagged.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        text = plan(flagged)
    assert len(shares) == 4 and max(shares) < 1.2 * min(shares)
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_aggregates_combine_before_the_shuffle(spark, hot_log):
    for df in (dedup.keep_first(hot_log), dedup.keep_latest(hot_log), reg.build_registry(hot_log)):
        assert "partial_m" in plan(df)


def test_first_positions_scan_only_what_they_need(spark):
    log = catalog.event_log(spark, SF_DIR)
    with session_conf(spark, NO_BROADCAST):
        text = plan(dedup.classify(log))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def test_copies_of_one_record_are_split_by_the_engine(spark):
    copies = spark.range(0, 30_000, 1, 8).select(
        F.lit(0).alias("partition"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("offset"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )
    with session_conf(spark, SPLIT_EARLY):
        flagged = dedup.classify(copies)
        assert len(flagged.where("not is_duplicate").collect()) == 30_000
        flagged.collect()
        assert "skew=true" in plan(flagged)


def test_hot_lookups_are_split_by_the_engine(spark, hot_log):
    with session_conf(spark, SPLIT_EARLY):
        found = reg.lookup(hot_log.select("key", "value"), reg.build_registry(hot_log))
        rows = found.collect()
        assert "skew=true" in plan(found)
    assert len(rows) == 30_000 and {r["first_offset"] for r in rows if r["key"] == "hot"} == {0}


def test_hot_batch_is_split_by_the_engine(spark, hot_log):
    rows = hot_log.withColumn("batch_id", F.when(F.col("key") == "hot", -1).otherwise(F.col("offset")).cast("bigint"))
    done = rows.groupBy("batch_id").agg(F.max("offset").alias("last"))
    with session_conf(spark, SPLIT_EARLY):
        kept = batches.read_committed(rows, done)
        assert len(kept.collect()) == 30_000
        assert "skew=true" in plan(kept)


def test_one_large_flush_is_sorted_by_many_tasks(spark, tmp_path):
    events = spark.range(0, 20_000, 1, 4).select(
        F.lit(0).alias("flush_id"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit("A").alias("eventType"), F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("x").alias("payload"),
    )
    path = str(tmp_path / "out")
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        emitted = buf.buffer_and_sort(events)
        assert "Window" not in plan(emitted)
        sink.write_flushes(emitted, path)
    files = glob.glob(f"{path}/flush_id=0/*.parquet")
    assert len(files) == 4
    ends = []
    for f in files:
        got = [(r["pos"], r["id"]) for r in spark.read.parquet(f).collect()]
        assert got == sorted(got) and [i for _, i in got] == sorted(i for _, i in got)
        ends.append((got[0][0], got[-1][0]))
    ends.sort()
    assert ends[0][0] == 1 and ends[-1][1] == 20_000
    assert all(a[1] + 1 == b[0] for a, b in zip(ends, ends[1:]))
    assert max(b - a for a, b in ends) < 2 * 20_000 / 4


def test_block_starts_are_broadcast_only_when_small(spark, hot_log, monkeypatch):
    places = hot_log.select("partition", "offset")
    assert "BroadcastHashJoin" in plan(ranking.with_position(places, ["partition"], ["offset"]))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    with session_conf(spark, NO_BROADCAST):
        assert "SortMergeJoin" in plan(ranking.with_position(places, ["partition"], ["offset"]))


def test_a_small_batch_leaves_the_registry_where_it_is(spark, hot_log, monkeypatch):
    known = reg.build_registry(hot_log.where("offset < 20000"))
    firsts = settle(dedup.first_positions(hot_log.where("offset >= 15000")))
    with session_conf(spark, NO_BROADCAST):
        small = reg.unregistered(firsts, known)
        assert "BroadcastHashJoin" in plan(small)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        large = reg.unregistered(firsts, known)
        assert "Broadcast" not in plan(large)
        want = hot_log.where("offset >= 20000 and key <> 'hot'").count()
        assert small.count() == large.count() == want


def test_bucketed_registry_is_not_shuffled(spark, hot_log):
    reg.save_bucketed(reg.build_registry(hot_log), "first_seen_registry", 4)
    try:
        known = spark.table("first_seen_registry")
        with session_conf(spark, FIXED_PLAN):
            added = reg.new_entries(hot_log, known)
            text = plan(added)
            assert added.count() == 0
        right = text[text.index("LeftAnti"):].split("\n   :- ")[-1].split("\n   +- ")[-1]
        assert "Bucketed: true" in right and "Exchange" not in right
    finally:
        spark.sql("DROP TABLE first_seen_registry")


def test_batch_operators_stay_in_the_jvm(spark):
    for name in ("d1_classify", "d2_keep_first", "d6_dedup_against_earlier", "b3_sorted_flushes", "j1_parse_events"):
        text = plan(catalog.QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "InPandas" not in text and "Cartesian" not in text


def test_payloads_stay_out_of_checkpoints(spark, monkeypatch):
    """Sorted blocks are read twice: by their group and row number, and once with all columns."""
    settled = []

    def watched(df):
        settled.append((df.columns, plan(df)))
        return settle(df)

    monkeypatch.setattr(ranking, "settle", watched)
    events = spark.range(0, 5_000, 1, 4).selectExpr(
        "id % 3 AS flush_id", "0 AS partition", "id AS offset", "'A' AS eventType", "sha2(cast(id AS string), 256) AS id", "'x' AS payload"
    )
    emitted = buf.buffer_and_sort(events)
    assert emitted.count() == 5_000
    assert [columns for columns, _ in settled] == [["_g_flush_id", "_g_partition", "_b", "_base"]]
    assert "ReadSchema: struct<flush_id:bigint,partition:int,_row:bigint>" in settled[0][1]
    got = emitted.groupBy("flush_id").agg(F.max("pos").alias("n"), F.count_distinct("pos").alias("d")).collect()
    assert sorted((r["n"], r["d"]) for r in got) == [(1666, 1666), (1667, 1667), (1667, 1667)]


def test_check_rebuild_shuffles_digests(spark, hot_log, monkeypatch):
    """The wide values of both sides are aggregated only where the sides disagree."""
    settled = []

    def watched(df):
        settled.append(plan(df))
        return settle(df)

    monkeypatch.setattr(reg, "settle", watched)
    wrong = hot_log.where("offset <> 1").selectExpr("value").unionByName(spark.createDataFrame([("x",), ("x",), (None,)], "value string"))
    got = reg.check_rebuild(hot_log, reg.build_registry(hot_log), wrong).collect()
    first = hot_log.where("offset = 1").first()["value"]
    hot = 10_000 - 1
    assert sorted((r["value"] or "", r["side"]) for r in got if r["side"] == "missing") == [(first, "missing")]
    assert sum(r["side"] == "unexpected" for r in got) == hot + 2
    (text,) = settled
    assert text.count("sha2") >= 2 and "value" not in text[: text.index("sha2")]
