"""The registered queries, each with the same question in SQL.

Every query reads whole given tables. ``events`` serves as the record log
(offset ``event_id``, key ``event_type || ' ' || user_id``), alone or split into
four source partitions by user, in which offsets have gaps; ``orders`` is a log
whose three keys hold a third of the rows each; ``documents`` are deduplicated by
the hash of their whole text.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import event_json as ej, events as ev
from ..functions.keys import hashed_key, plain_key, with_key
from ..operators import buffer as buf, dedup, registry as reg
from ..operators.accounting import batch_accounting
from ..operators.ranking import with_position
from ..session import scratch_path, settle
from ..sinks import committed as sink
from ..sources import batches, positions as pos
from ..sources.logs import read_table, stream_files, to_records
from ..streaming import buffer as sbuf, control, dedup as sdedup, keyed_state as keyed, monitor, windows
from ..sinks.manifest import Fenced
from .dedup_job import DedupJob
from .sort_job import sort_log

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# ---- inputs ---------------------------------------------------------------

LANES = 4


def event_log(spark: SparkSession, d: str, lanes: int = 1) -> DataFrame:
    part = 0 if lanes == 1 else F.pmod("user_id", F.lit(lanes))
    return to_records(
        read_table(spark, d, "events"),
        offset="event_id",
        key=plain_key("event_type", "user_id"),
        value="props",
        partition=part,
        ts="ts",
    )


def event_rows(spark: SparkSession, d: str, lanes: int = 1) -> DataFrame:
    """``events`` in the shape of the sort job's input."""
    part = F.lit(0) if lanes == 1 else F.pmod("user_id", F.lit(lanes))
    return read_table(spark, d, "events").select(
        part.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("eventType"),
        F.col("user_id").cast("string").alias("id"),
        F.col("props").alias("payload"),
        "ts",
    )


def order_log(spark: SparkSession, d: str) -> DataFrame:
    return to_records(
        read_table(spark, d, "orders"),
        offset="o_orderkey",
        key="o_orderstatus",
        value="o_orderpriority",
        ts="o_orderdate",
    )


def document_log(spark: SparkSession, d: str) -> DataFrame:
    return to_records(
        with_key(read_table(spark, d, "documents"), hashed_key("text")),
        offset="doc_id",
        key="key",
        value="source",
        lang="lang",
    )


def line_values(spark: SparkSession, d: str) -> DataFrame:
    """Event JSON made from ``lineitem``, with null, broken and incomplete values.

    The return flag R is no event type, A and N are.
    """
    text = ej.event_json("l_returnflag", "l_orderkey", "l_linestatus")
    value = (
        F.when(F.col("l_tax") == 0, None)
        .when(F.col("l_discount") == 0, F.concat(F.lit("{"), "l_returnflag"))
        .when(F.col("l_quantity") == 1, ej.event_json(F.lit(None), "l_orderkey", "l_linestatus"))
        .when(F.col("l_quantity") == 2, ej.event_json("l_returnflag", "l_orderkey", F.lit(None)))
        .otherwise(text)
    )
    return to_records(
        read_table(spark, d, "lineitem"),
        offset=F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        key=None,
        value=value,
    )


_LOG = """(SELECT 0 AS "partition", event_id AS "offset", event_type || ' ' || user_id AS "key",
  props AS "value", ts FROM events)"""
_LANES = """(SELECT CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
  event_type || ' ' || user_id AS "key", props AS "value", ts FROM events)"""
_ORDERS = """(SELECT 0 AS "partition", o_orderkey AS "offset", o_orderstatus AS "key",
  o_orderpriority AS "value", o_orderdate AS ts FROM orders)"""
_RANKED = f"""(SELECT *, CAST((row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1) // 1000
  AS BIGINT) AS batch_id FROM {_LANES})"""

MIDWAY = "2024-01-11 00:00:00"


def _midway(log: DataFrame) -> dict[int, int]:
    """Positions committed by a run that stopped at a fixed event time."""
    earlier = log.where(F.col("ts") < F.lit(MIDWAY).cast("timestamp_ntz"))
    return pos.collect_positions(pos.last_positions(earlier))


_MIDWAY = f"""(SELECT "partition", max("offset") AS committed FROM {_LANES}
  WHERE ts < TIMESTAMP '{MIDWAY}' GROUP BY 1)"""


# ---- sources, positions, batches ------------------------------------------


@register(f'SELECT "partition", "offset", "key", "value" FROM {_LOG}')
def s1_read_records(spark: SparkSession, d: str) -> DataFrame:
    return event_log(spark, d).drop("ts")


@register(
    f"""SELECT l."partition", "offset", "key", "value" FROM {_LANES} l LEFT JOIN {_MIDWAY} c
    ON l."partition" = c."partition" WHERE "offset" > coalesce(committed, -1)"""
)
def s2_resume_after_commit(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    return pos.resume_after(log, _midway(log)).drop("ts")


_MANY = """(SELECT CAST(event_id % 200 AS INTEGER) AS "partition", event_id AS "offset",
  event_type || ' ' || user_id AS "key" FROM events)"""


def _many(spark: SparkSession, d: str) -> tuple[DataFrame, dict[int, int]]:
    """A log of 200 source partitions, and another position in each."""
    log = event_log(spark, d).withColumn("partition", (F.col("offset") % 200).cast("int"))
    return log.select("partition", "offset", "key"), {p: 100 + 4 * p for p in range(200)}


@register(f"""SELECT * FROM {_MANY} WHERE "offset" > 100 + 4 * "partition\"""")
def s2_resume_many_partitions(spark: SparkSession, d: str) -> DataFrame:
    return pos.resume_after(*_many(spark, d))


@register(f"""SELECT * FROM {_MANY} WHERE "partition" >= 150 OR "offset" >= 100 + 4 * "partition\"""")
def s3_replay_many_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The last 50 partitions have no position and are read in full."""
    log, starts = _many(spark, d)
    return pos.replay_from(log, {p: o for p, o in starts.items() if p < 150})


def _every_fifth_lost(spark: SparkSession, d: str) -> tuple[DataFrame, dict[int, int]]:
    log, starts = _many(spark, d)
    return log, {p: -5 if p % 5 == 0 else o for p, o in starts.items()}


@register(f"""SELECT * FROM {_MANY} WHERE "partition" % 5 = 0 OR "offset" >= 100 + 4 * "partition\"""")
def s4_reset_many_to_earliest(spark: SparkSession, d: str) -> DataFrame:
    return pos.start_at(*_every_fifth_lost(spark, d), "earliest")


@register(f"""SELECT * FROM {_MANY} WHERE "partition" % 5 <> 0 AND "offset" >= 100 + 4 * "partition\"""")
def s4_reset_many_to_latest(spark: SparkSession, d: str) -> DataFrame:
    return pos.start_at(*_every_fifth_lost(spark, d), "latest")


@register(
    f"""SELECT l."partition", "offset", "key" FROM {_LANES} l JOIN {_MIDWAY} c
    ON l."partition" = c."partition" WHERE "offset" >= committed"""
)
def s3_replay_from_offset(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    return pos.replay_from(log, _midway(log)).select("partition", "offset", "key")


def _off_the_end(spark: SparkSession, d: str) -> tuple[DataFrame, dict[int, int]]:
    """Partition 1 starts far beyond its end, the others midway."""
    log = event_log(spark, d, LANES)
    starts = _midway(log)
    starts[1] += 1_000_000_000
    return log, starts


@register(
    f"""SELECT l."partition", "offset", "key" FROM {_LANES} l JOIN {_MIDWAY} c
    ON l."partition" = c."partition" WHERE "offset" >= committed OR l."partition" = 1"""
)
def s4_reset_to_earliest(spark: SparkSession, d: str) -> DataFrame:
    log, starts = _off_the_end(spark, d)
    return pos.start_at(log, starts, "earliest").select("partition", "offset", "key")


@register(
    f"""SELECT l."partition", "offset", "key" FROM {_LANES} l JOIN {_MIDWAY} c
    ON l."partition" = c."partition" WHERE "offset" >= committed AND l."partition" <> 1"""
)
def s4_reset_to_latest(spark: SparkSession, d: str) -> DataFrame:
    log, starts = _off_the_end(spark, d)
    return pos.start_at(log, starts, "latest").select("partition", "offset", "key")


@register(
    f"""SELECT "offset", "key", "value" FROM {_LOG} WHERE date_trunc('hour', ts) IN
    (SELECT date_trunc('hour', ts) FROM events GROUP BY 1
     HAVING arg_max(event_type, event_id) <> 'error')"""
)
def s5_read_committed(spark: SparkSession, d: str) -> DataFrame:
    """Hours are the producer's transactions; one whose last event is an error was aborted."""
    table = read_table(spark, d, "events")
    hour = F.date_trunc("hour", "ts").alias("batch_id")
    done = (
        table.groupBy(hour)
        .agg(F.max_by("event_type", "event_id").alias("last"))
        .where("last <> 'error'")
    )
    log = event_log(spark, d).withColumn("batch_id", F.date_trunc("hour", "ts"))
    return batches.read_committed(log, done).select("offset", "key", "value")


@register(f'SELECT "partition", "offset", batch_id FROM {_RANKED}')
def s6_assign_batches(spark: SparkSession, d: str) -> DataFrame:
    return batches.assign_batches(event_log(spark, d, LANES).select("partition", "offset"))


@register(
    """SELECT o_orderkey AS "offset", o_orderstatus AS "eventType",
    CAST(o_custkey AS VARCHAR) AS id, o_orderpriority AS payload FROM orders"""
)
def s7_read_event_json(spark: SparkSession, d: str) -> DataFrame:
    log = to_records(
        read_table(spark, d, "orders"),
        offset="o_orderkey",
        key=None,
        value=ej.event_json("o_orderstatus", "o_custkey", "o_orderpriority"),
    )
    return ej.good_events(ej.parse_events(log)).select("offset", "eventType", "id", "payload")


@register(
    """SELECT time_bucket(INTERVAL '10 minutes', ts) AS poll, count(*) AS n_in,
    max(event_id) AS committed_offset FROM events GROUP BY 1"""
)
def s8_skip_empty_polls(spark: SparkSession, d: str) -> DataFrame:
    """Polls every ten minutes; those without records leave no trace."""
    polls = event_log(spark, d).withColumn("poll", F.window("ts", "10 minutes")["start"])
    flagged = polls.withColumn("is_duplicate", F.lit(None).cast("boolean"))
    return batch_accounting(flagged, ["poll"]).select("poll", "n_in", "committed_offset")


# ---- projections, scalar functions, encoding ------------------------------


@register(
    """SELECT event_id AS "offset", event_type AS "eventType", CAST(user_id AS VARCHAR) AS id,
    upper(props) AS payload FROM events"""
)
def p1_upper_payload(spark: SparkSession, d: str) -> DataFrame:
    return ev.upper_payload(event_rows(spark, d)).select("offset", *buf.EVENT_COLUMNS)


@register(
    """SELECT o_orderkey AS "offset", o_orderstatus || ' ' ||
    coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END, 'null')
    AS sort_key FROM orders"""
)
def p2_sort_key(spark: SparkSession, d: str) -> DataFrame:
    ident = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("offset"), ev.sort_key("o_orderstatus", ident).alias("sort_key")
    )


@register('SELECT props AS "value" FROM events')
def p3_value_only(spark: SparkSession, d: str) -> DataFrame:
    return ev.value_only(event_log(spark, d))


@register('SELECT CAST(NULL AS VARCHAR) AS "key", event_id AS "offset", props AS "value" FROM events')
def p4_null_key(spark: SparkSession, d: str) -> DataFrame:
    return ev.with_null_key(event_log(spark, d)).select("key", "offset", "value")


@register(
    'SELECT doc_id AS "offset", sha256(text) AS "key", lang, source AS "value" FROM documents'
)
def p5_choose_dedup_key(spark: SparkSession, d: str) -> DataFrame:
    return document_log(spark, d).select("offset", "key", "lang", "value")


@register(
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_returnflag IN ('A', 'N') AS is_known,
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 14 END AS BIGINT) AS ordinal FROM lineitem"""
)
def p6_check_type_domain(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        ev.is_known_type("l_returnflag").alias("is_known"),
        ev.type_ordinal("l_returnflag").alias("ordinal"),
    )


@register(
    """SELECT event_id AS "offset", event_type AS "eventType" FROM events
    WHERE event_type NOT IN ('signup', 'error')"""
)
def p6_skip_control_types(spark: SparkSession, d: str) -> DataFrame:
    rows = ev.without_control_types(event_rows(spark, d), control=("signup", "error"))
    return rows.select("offset", "eventType")


@register(
    """SELECT o_orderkey AS "offset", o_orderpriority AS "value" FROM orders
    WHERE o_orderstatus <> 'P'"""
)
def p7_skip_tombstones(spark: SparkSession, d: str) -> DataFrame:
    """Pending orders have no value yet."""
    value = F.when(F.col("key") != "P", F.col("value"))
    return ev.without_tombstones(order_log(spark, d).withColumn("value", value)).select("offset", "value")


@register(
    """SELECT DISTINCT l_returnflag AS "eventType",
    CASE WHEN l_tax > 0 THEN CAST(l_suppkey AS VARCHAR) END AS id, l_linestatus AS payload FROM lineitem"""
)
def p8_distinct_events(spark: SparkSession, d: str) -> DataFrame:
    return ev.distinct_events(
        read_table(spark, d, "lineitem").select(
            F.col("l_returnflag").alias("eventType"),
            F.when(F.col("l_tax") > 0, F.col("l_suppkey").cast("string")).alias("id"),
            F.col("l_linestatus").alias("payload"),
        )
    )


@register(
    """SELECT c_custkey, (CASE WHEN c_acctbal > 0 THEN c_nationkey END) IS NOT DISTINCT FROM
    (CASE WHEN s_acctbal > 0 THEN s_nationkey END) AS same
    FROM customer JOIN supplier ON c_custkey = s_suppkey"""
)
def p8_same_event(spark: SparkSession, d: str) -> DataFrame:
    """Events of a customer and a supplier with the same number; debtors have no id."""

    def event(prefix: str) -> F.Column:
        ident = F.when(F.col(f"{prefix}_acctbal") > 0, F.col(f"{prefix}_nationkey"))
        return F.struct(
            F.lit("A").alias("eventType"),
            ident.cast("string").alias("id"),
            F.lit(None).cast("string").alias("payload"),
        )

    left = read_table(spark, d, "customer").select("c_custkey", event("c").alias("ce"))
    right = read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), event("s").alias("se"))
    return left.join(right, "c_custkey").select("c_custkey", ev.same_event("ce", "se").alias("same"))


@register(
    """SELECT l_orderkey * 8 + l_linenumber AS "offset", l_returnflag AS "eventType",
    CAST(l_orderkey AS VARCHAR) AS id, l_linestatus AS payload FROM lineitem
    WHERE l_tax <> 0 AND l_discount <> 0 AND l_quantity NOT IN (1, 2) AND l_returnflag <> 'R'"""
)
def j1_parse_events(spark: SparkSession, d: str) -> DataFrame:
    parsed = ej.parse_events(line_values(spark, d))
    return ej.good_events(parsed).select("offset", *buf.EVENT_COLUMNS)


@register(
    """SELECT "offset", reason FROM (SELECT l_orderkey * 8 + l_linenumber AS "offset",
    CASE WHEN l_tax = 0 THEN 'null value' WHEN l_discount = 0 THEN 'malformed json'
    WHEN l_quantity = 1 THEN 'missing event type' WHEN l_returnflag = 'R' THEN 'unknown event type'
    WHEN l_quantity = 2 THEN 'missing payload' END AS reason FROM lineitem) WHERE reason IS NOT NULL"""
)
def j1_event_rejects(spark: SparkSession, d: str) -> DataFrame:
    return ej.event_rejects(ej.parse_events(line_values(spark, d))).select("offset", "reason")


@register(
    """SELECT o_orderkey AS "offset", '{"eventType":"' || o_orderstatus || '"' ||
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE ',"id":"' || o_custkey || '"' END ||
    ',"payload":"' || o_orderpriority || '"}' AS "value" FROM orders"""
)
def j2_write_event_json(spark: SparkSession, d: str) -> DataFrame:
    ident = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("offset"),
        ej.event_json("o_orderstatus", ident, "o_orderpriority").alias("value"),
    )


# ---- dedup ----------------------------------------------------------------


@register(
    f"""SELECT "offset", "key", "value", "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM {_LOG}"""
)
def d1_classify(spark: SparkSession, d: str) -> DataFrame:
    return dedup.classify(event_log(spark, d)).select("offset", "key", "value", "is_duplicate")


@register(
    f"""SELECT "offset", "key", "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM {_ORDERS}"""
)
def d1_classify_hot_keys(spark: SparkSession, d: str) -> DataFrame:
    return dedup.classify(order_log(spark, d)).select("offset", "key", "is_duplicate")


@register(
    """SELECT l_orderkey * 8 + l_linenumber AS "offset", l_returnflag || ' ' || l_linestatus AS "key",
    l_partkey, "offset" <> min("offset") OVER (PARTITION BY "key") AS is_duplicate FROM lineitem"""
)
def d1_classify_shared_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Different keys at one offset, and several rows of one key at its first offset."""
    log = to_records(
        read_table(spark, d, "lineitem"),
        offset=F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        key=plain_key("l_returnflag", "l_linestatus"),
        value=None,
        l_partkey="l_partkey",
    )
    return dedup.classify(log).select("offset", "key", "l_partkey", "is_duplicate")


@register(
    f"""SELECT "offset", "key", "value", ts FROM {_LOG}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset") = 1"""
)
def d2_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(event_log(spark, d)).drop("partition")


@register(
    """SELECT doc_id AS "offset", lang, source AS "value" FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""
)
def d2_keep_first_documents(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(document_log(spark, d)).select("offset", "lang", "value")


@register(
    f"""SELECT "offset", "key", "value" FROM {_LOG}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset") > 1"""
)
def d3_kickouts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.kickouts(dedup.classify(event_log(spark, d))).select("offset", "key", "value")


@register(
    f"""SELECT "key", min("offset") AS first_offset, arg_min(ts, "offset") AS first_seen
    FROM {_LOG} GROUP BY "key\""""
)
def d4_build_registry(spark: SparkSession, d: str) -> DataFrame:
    return reg.build_registry(event_log(spark, d), seen="ts").drop("partition")


_EXTENDED = f"""WITH early AS (SELECT * FROM {_LANES} l JOIN {_MIDWAY} c USING ("partition")
  WHERE "offset" <= committed), late AS (SELECT * FROM {_LANES} l JOIN {_MIDWAY} c USING ("partition")
  WHERE "offset" > committed), known AS (SELECT "key", min("offset") AS first_offset,
  arg_min(ts, "offset") AS first_seen FROM early GROUP BY 1)"""


def _early(log: DataFrame, committed: dict[int, int]) -> DataFrame:
    """The part of the log up to the committed positions."""
    return reg.rebuild(log, committed, seen="ts")


@register(
    f"""{_EXTENDED} SELECT * FROM known UNION ALL SELECT "key", min("offset"), arg_min(ts, "offset")
    FROM late WHERE "key" NOT IN (SELECT "key" FROM known) GROUP BY 1"""
)
def d4_extend_registry(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    committed = _midway(log)
    known = _early(log, committed)
    return reg.extend_registry(known, pos.resume_after(log, committed), seen="ts").drop("partition")


@register(
    f"""SELECT a."key", first_offset, first_seen FROM
    (SELECT 'purchase ' || c_custkey AS "key" FROM customer) a LEFT JOIN
    (SELECT "key", min("offset") AS first_offset, arg_min(ts, "offset") AS first_seen
     FROM {_LOG} GROUP BY 1) r ON a."key" = r."key\""""
)
def d5_look_up_keys(spark: SparkSession, d: str) -> DataFrame:
    """Has customer N ever bought something?"""
    asked = read_table(spark, d, "customer").select(plain_key(F.lit("purchase"), "c_custkey").alias("key"))
    known = reg.build_registry(event_log(spark, d), seen="ts")
    return reg.lookup(asked, known).drop("partition")


@register(
    f"""{_EXTENDED} SELECT "offset", "key", "value", "key" IN (SELECT "key" FROM known) OR
    "offset" <> min("offset") OVER (PARTITION BY "key") AS is_duplicate FROM late"""
)
def d6_dedup_against_earlier(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    committed = _midway(log)
    flagged = reg.dedup_increment(log, _early(log, committed), committed)
    return flagged.select("offset", "key", "value", "is_duplicate")


@register(
    f"""SELECT "offset", "key", is_duplicate FROM (SELECT *, "offset" <> min("offset")
    OVER (PARTITION BY "key") AS is_duplicate FROM {_LANES}) l JOIN {_MIDWAY} c
    ON l."partition" = c."partition" WHERE "offset" >= committed"""
)
def d7_replay_same_answer(spark: SparkSession, d: str) -> DataFrame:
    """The registry has already seen the whole log when its last part is read again."""
    log = event_log(spark, d, LANES)
    again = pos.replay_from(log, _midway(log))
    return dedup.classify(again, reg.build_registry(log)).select("offset", "key", "is_duplicate")


class _Injected(RuntimeError):
    """The fault raised on purpose by d8."""


@register(
    f"""SELECT "offset", "key", "value" FROM {_LOG}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset") = 1"""
)
def d8_retry_after_abort(spark: SparkSession, d: str) -> DataFrame:
    """A first run commits a part, the second fails on its kick-outs, the third succeeds."""
    root = scratch_path(spark, "retry")
    log = event_log(spark, d)
    DedupJob(spark, root, seen="ts").run(log.where(F.col("ts") < F.lit(MIDWAY).cast("timestamp_ntz")))

    def fail(_rows: DataFrame, _batch_id: int) -> None:
        raise _Injected

    try:
        DedupJob(spark, root, seen="ts", on_kickouts=fail).run(log)
    except _Injected:
        pass
    job = DedupJob(spark, root, seen="ts")
    job.run(log)
    return job.output().select("offset", "key", "value")


_BY_TYPE = """(SELECT CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
  event_type AS "key" FROM events)"""


def _by_type(spark: SparkSession, d: str) -> DataFrame:
    return to_records(
        read_table(spark, d, "events"),
        offset="event_id",
        key="event_type",
        value=None,
        partition=F.pmod("user_id", F.lit(LANES)),
    )


@register(
    f"""SELECT *, "offset" <> min("offset") OVER (PARTITION BY "partition", "key") AS is_duplicate
    FROM {_BY_TYPE}"""
)
def d9_partition_scope(spark: SparkSession, d: str) -> DataFrame:
    return dedup.classify(_by_type(spark, d), scope="partition").drop("value")


@register(
    f"""SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY "partition", "offset") > 1
    AS is_duplicate FROM {_BY_TYPE}"""
)
def d9_topic_scope(spark: SparkSession, d: str) -> DataFrame:
    return dedup.classify(_by_type(spark, d), scope="topic").drop("value")


PURGE = "2024-01-02 00:00:00"


@register(
    f"""SELECT "key", min("offset") AS first_offset, arg_min(ts, "offset") AS first_seen FROM {_LOG}
    GROUP BY 1 HAVING first_seen >= TIMESTAMP '{PURGE}'"""
)
def d10_purge(spark: SparkSession, d: str) -> DataFrame:
    known = reg.build_registry(event_log(spark, d), seen="ts")
    return reg.purge(known, F.lit(PURGE).cast("timestamp_ntz")).drop("partition")


@register(
    f"""{_EXTENDED} SELECT "offset", "key", "key" IN (SELECT "key" FROM known
    WHERE first_seen >= TIMESTAMP '{PURGE}') OR "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM late"""
)
def d10_new_again_after_purge(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    committed = _midway(log)
    known = reg.purge(_early(log, committed), F.lit(PURGE).cast("timestamp_ntz"))
    return reg.dedup_increment(log, known, committed).select("offset", "key", "is_duplicate")


@register(f"{_EXTENDED} SELECT * FROM known")
def d11_rebuild_registry(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d, LANES)
    return reg.rebuild(log, _midway(log), seen="ts").drop("partition")


@register(
    """WITH log AS (SELECT doc_id, text AS "value" FROM documents), firsts AS
    (SELECT DISTINCT "value" FROM log), written AS (SELECT DISTINCT text AS "value" FROM documents
     WHERE lang <> 'en' UNION SELECT DISTINCT html FROM pages)
    SELECT sha256("value") AS "value", 'missing' AS side FROM firsts
    WHERE "value" NOT IN (SELECT "value" FROM written) UNION ALL
    SELECT sha256("value"), 'unexpected' FROM written WHERE "value" NOT IN (SELECT "value" FROM firsts)"""
)
def d11_check_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """An output that lost the English texts and holds web pages instead."""
    docs = read_table(spark, d, "documents")
    log = to_records(docs, offset="doc_id", key=hashed_key("text"), value=hashed_key("text"))
    pages = read_table(spark, d, "pages").select(hashed_key("html").alias("value"))
    output = docs.where("lang <> 'en'").select(hashed_key("text").alias("value")).unionByName(pages)
    return reg.check_rebuild(log, reg.build_registry(log), output)


@register(
    f"""SELECT "key", min("offset") AS first_offset, arg_min(ts, "offset") AS first_seen
    FROM {_LOG} GROUP BY 1"""
)
def d12_backup_and_restore(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "backup")
    reg.backup(reg.build_registry(event_log(spark, d), seen="ts"), path, batch_id=0)
    return reg.restore(spark, path, batch_id=0).drop("partition")


_FLAGGED = f"""SELECT "offset", "key", "value", "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM {_LOG}"""


def _midway_job(spark: SparkSession, log: DataFrame, reset: str | None = None) -> DedupJob:
    """A job that has run over the early part of the log, as its batch 0."""
    job = DedupJob(spark, scratch_path(spark, "job"), seen="ts", reset=reset)
    job.run(pos.up_to(log, _midway(log)))
    return job


def _flagged(job: DedupJob) -> DataFrame:
    sides = [job.output(o).withColumn("is_duplicate", F.lit(o == "kickout")) for o in ("unique", "kickout")]
    return sides[0].unionByName(sides[1]).select("batch_id", "offset", "key", "value", "is_duplicate")


def _flagged_batch(job: DedupJob, batch_id: int) -> DataFrame:
    return _flagged(job).where(F.col("batch_id") == batch_id).select("offset", "key", "is_duplicate")


@register(
    f"""{_EXTENDED} SELECT "offset", "key", "key" IN (SELECT "key" FROM known
    WHERE first_seen >= TIMESTAMP '{PURGE}') OR "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM late"""
)
def d10_job_after_purge(spark: SparkSession, d: str) -> DataFrame:
    """The incremental job forgets old keys between two runs."""
    log = event_log(spark, d, LANES)
    job = _midway_job(spark, log)
    job.purge(F.lit(PURGE).cast("timestamp_ntz"))
    job.run(log)
    return _flagged_batch(job, 1)


_LATE = """SELECT "offset", "key", "key" IN (SELECT "key" FROM known)
    OR "offset" <> min("offset") OVER (PARTITION BY "key") AS is_duplicate FROM late"""


@register(f"{_EXTENDED} {_LATE}")
def d11_job_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """A job whose files are lost goes on from the input log and the committed positions."""
    log = event_log(spark, d, LANES)
    job = DedupJob(spark, scratch_path(spark, "rebuilt"), seen="ts")
    job.rebuild(log, _midway(log))
    job.run(log)
    return _flagged_batch(job, 0)


@register(f"{_EXTENDED} {_LATE}")
def d12_job_from_backup(spark: SparkSession, d: str) -> DataFrame:
    """A job goes on in a new place from a backup of its registry."""
    log = event_log(spark, d, LANES)
    old, path = _midway_job(spark, log), scratch_path(spark, "backup")
    reg.backup(old.registry(), path, batch_id=0)
    job = DedupJob(spark, scratch_path(spark, "restored"), seen="ts")
    job.restore(reg.restore(spark, path, batch_id=0), old.positions())
    job.run(log)
    return _flagged_batch(job, 0)


@register(_FLAGGED)
def d6_job_many_runs(spark: SparkSession, d: str) -> DataFrame:
    """Ten bounded runs over a registry of many buckets; the pieces of the first eight are merged."""
    log = event_log(spark, d)
    size = log.select(F.ceil((F.max("offset") + 1) / 10)).first()[0]
    job = DedupJob(spark, scratch_path(spark, "many"), seen="ts", buckets=64)
    while job.run(log, max_offsets=size) is not None:
        pass
    return _flagged(job).drop("batch_id")


@register(
    f"""{_EXTENDED} SELECT "offset", "key", "key" IN (SELECT "key" FROM known
    WHERE first_seen >= TIMESTAMP '{PURGE}') OR "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM late"""
)
def d10_job_purged_and_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Compacted, purged and compacted again on the same batch; then the next run."""
    log = event_log(spark, d, LANES)
    job = _midway_job(spark, log)
    job.compact()
    job.purge(F.lit(PURGE).cast("timestamp_ntz"))
    job.compact()
    job.run(log)
    return _flagged_batch(job, 1)


@register(
    f"""SELECT "offset", "key", "value", "offset" <> min("offset") OVER (PARTITION BY "key") AS is_duplicate,
    true AS refused FROM {_LOG}"""
)
def m5_take_over(spark: SparkSession, d: str) -> DataFrame:
    """A run loses its lease before it commits, another one takes over, and the late commit is refused."""
    root, log = scratch_path(spark, "taken"), event_log(spark, d)
    half = log.select(F.floor(F.max("offset") / 2)).first()[0]
    job = DedupJob(spark, root, seen="ts")

    def overtaken(_rows: DataFrame, _batch_id: int) -> None:
        job.run(log)

    refused = False
    try:
        # a lease of no time stands for one that ran out while the driver was not heard of
        slow = DedupJob(spark, root, seen="ts", on_kickouts=overtaken, lease_seconds=0)
        slow.run(log.where(F.col("offset") <= half))
    except Fenced:
        refused = True
    return _flagged(job).drop("batch_id").withColumn("refused", F.lit(refused))


@register(f"""{_EXTENDED} {_LATE} WHERE "offset" >= (SELECT max(event_id) * 3 // 4 FROM events)""")
def s4_job_reset_to_earliest(spark: SparkSession, d: str) -> DataFrame:
    """The log was cut beyond the job's positions; it goes on from what is left, after a compaction."""
    log = event_log(spark, d, LANES)
    job = _midway_job(spark, log, reset="earliest")
    job.compact()
    cut = log.select(F.floor(F.max("offset") * 3 / 4)).first()[0]
    job.run(log.where(F.col("offset") >= cut))
    return _flagged_batch(job, 1)


@register(
    f"""SELECT "offset", "key", "value", ts FROM {_LOG}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset" DESC) = 1"""
)
def d13_compaction(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_latest(event_log(spark, d)).drop("partition")


@register(
    f"""SELECT "offset", "key", "value" FROM {_LOG}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset") = 1"""
)
def d14_idempotent_append(spark: SparkSession, d: str) -> DataFrame:
    """The same rows are appended twice and land once."""
    path = scratch_path(spark, "append")
    firsts = dedup.keep_first(event_log(spark, d)).select("offset", "key", "value")
    sink.append_new(firsts, path, on=["key"])
    sink.append_new(firsts, path, on=["key"])
    return spark.read.parquet(path)


@register(
    """SELECT min(event_id) AS "offset", CASE WHEN user_id % 7 > 0 THEN user_id END AS "key\"
    FROM events GROUP BY 2"""
)
def d14_append_null_keys(spark: SparkSession, d: str) -> DataFrame:
    """A null is a key like any other: it too lands once."""
    path = scratch_path(spark, "append")
    key = F.when(F.col("user_id") % 7 > 0, F.col("user_id")).alias("key")
    firsts = read_table(spark, d, "events").groupBy(key).agg(F.min("event_id").alias("offset"))
    for _ in range(2):
        sink.append_new(firsts, path, on=["key"])
    return spark.read.parquet(path)


# ---- buffer and sort ------------------------------------------------------

_HOURLY = """(SELECT date_trunc('hour', ts) AS flush_id, CAST(user_id % {lanes} AS INTEGER) AS "partition",
  event_type || ' ' || user_id AS sort_key, event_id AS "offset", event_type AS "eventType",
  CAST(user_id AS VARCHAR) AS id, upper(props) AS payload FROM events
  QUALIFY row_number() OVER (PARTITION BY flush_id, "partition", sort_key ORDER BY event_id DESC) = 1)"""


def _hourly(spark: SparkSession, d: str, lanes: int = 1) -> DataFrame:
    return event_rows(spark, d, lanes).withColumn("flush_id", buf.flush_window("1 hour"))


def _hourly_buffer(spark: SparkSession, d: str, lanes: int = 1) -> DataFrame:
    return buf.upsert(buf.prepare(_hourly(spark, d, lanes)))


@register(f"SELECT * FROM {_HOURLY.format(lanes=1)}")
def b1_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _hourly_buffer(spark, d)


@register(
    f"""SELECT flush_id, CAST(NULL AS VARCHAR) AS "key", "eventType", id, payload,
    row_number() OVER (PARTITION BY flush_id ORDER BY sort_key) AS pos FROM {_HOURLY.format(lanes=1)}"""
)
def b3_sorted_flushes(spark: SparkSession, d: str) -> DataFrame:
    return buf.buffer_and_sort(_hourly(spark, d)).drop("partition")


@register(
    f"""SELECT flush_id, "partition", CAST(NULL AS VARCHAR) AS "key", "eventType", id, payload,
    row_number() OVER (PARTITION BY flush_id, "partition" ORDER BY sort_key) AS pos
    FROM {_HOURLY.format(lanes=4)}"""
)
def b3_sorted_flushes_per_lane(spark: SparkSession, d: str) -> DataFrame:
    return buf.buffer_and_sort(_hourly(spark, d, LANES))


@register(
    f"""SELECT flush_id, "partition", "eventType", id, payload,
    row_number() OVER (PARTITION BY flush_id ORDER BY sort_key, "partition") AS pos
    FROM {_HOURLY.format(lanes=4)}"""
)
def b3_sorted_flushes_across_lanes(spark: SparkSession, d: str) -> DataFrame:
    return buf.buffer_and_sort(_hourly(spark, d, LANES), across_lanes=True).drop("key")


@register(
    """SELECT o_orderstatus AS "eventType", CAST(o_custkey AS VARCHAR) AS id,
    arg_max(upper(o_orderpriority), o_orderkey) AS payload,
    row_number() OVER (ORDER BY o_orderstatus || ' ' || o_custkey) AS pos
    FROM orders GROUP BY o_orderstatus, o_custkey"""
)
def b3_one_large_flush(spark: SparkSession, d: str) -> DataFrame:
    """All rows in a single flush of a single lane; the sort still spans all tasks."""
    events = read_table(spark, d, "orders").select(
        F.lit(0).alias("flush_id"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.col("o_orderstatus").alias("eventType"),
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("payload"),
    )
    return buf.buffer_and_sort(events).select(*buf.EVENT_COLUMNS, "pos")


_AT = "2024-01-20 12:30:00"


@register(
    f"""SELECT "partition", count(*) AS n_pending FROM {_HOURLY.format(lanes=4)}
    WHERE flush_id + INTERVAL 1 HOUR > TIMESTAMP '{_AT}' GROUP BY 1"""
)
def b4_pending_size(spark: SparkSession, d: str) -> DataFrame:
    """What is still buffered when the watermark stands at a given time."""
    at = F.lit(_AT).cast("timestamp_ntz")
    return buf.pending_size(buf.pending(_hourly_buffer(spark, d, LANES), at, "1 hour"))


@register(
    f"""SELECT flush_id, "eventType", id, payload FROM {_HOURLY.format(lanes=1)}
    WHERE sort_key = 'purchase 7'"""
)
def b5_look_up_buffered(spark: SparkSession, d: str) -> DataFrame:
    return buf.peek(_hourly_buffer(spark, d), "purchase 7").select("flush_id", *buf.EVENT_COLUMNS)


_DAILY = """(SELECT date_trunc('day', ts) AS flush_id, event_type || ' ' || user_id AS sort_key,
  event_type AS "eventType", CAST(user_id AS VARCHAR) AS id, upper(props) AS payload FROM events
  QUALIFY row_number() OVER (PARTITION BY flush_id, sort_key ORDER BY event_id DESC) = 1)"""


@register(
    f"""SELECT flush_id, "eventType", id, payload,
    row_number() OVER (PARTITION BY flush_id ORDER BY sort_key) AS pos FROM {_DAILY}
    WHERE flush_id + INTERVAL 1 DAY <= TIMESTAMP '{_AT}'"""
)
def b7_long_windows(spark: SparkSession, d: str) -> DataFrame:
    """Day-long buffers that the watermark has closed; the open ones stay back."""
    daily = event_rows(spark, d).withColumn("flush_id", buf.flush_window("1 day"))
    done = buf.closed(buf.upsert(buf.prepare(daily)), F.lit(_AT).cast("timestamp_ntz"), "1 day")
    return buf.sort_flushes(done).select("flush_id", *buf.EVENT_COLUMNS, "pos")


@register(
    """WITH r AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'missing type'
    WHEN o_orderkey % 5 = 0 THEN 'missing payload' WHEN o_orderkey % 3 = 0 THEN 'missing time' END AS reason FROM orders)
    SELECT coalesce(reason, 'flushed or superseded') AS outcome, count(*) AS n FROM r GROUP BY 1"""
)
def b1_no_event_is_lost(spark: SparkSession, d: str) -> DataFrame:
    """Flushed, superseded and rejected events add up to the input, with nulls in every field."""
    number = F.col("o_orderkey")
    events = read_table(spark, d, "orders").select(
        F.lit(0).alias("partition"),
        number.alias("offset"),
        F.when(number % 7 != 0, F.col("o_orderstatus")).alias("eventType"),
        F.when(number % 11 != 0, number % 100).alias("id"),
        F.when(number % 5 != 0, F.col("o_orderpriority")).alias("payload"),
        F.when(number % 3 != 0, F.col("o_orderdate").cast("timestamp")).alias("ts"),
    )
    flushed = events.withColumn("flush_id", buf.flush_window("1 day"))
    untimed = F.when(F.col("flush_id").isNull(), "missing time")
    good = flushed.where(buf.bad_event().isNull() & untimed.isNull())
    sent = buf.upsert(buf.prepare(good))
    superseded = good.join(sent.select("offset"), "offset", "left_anti")
    told = F.lit("flushed or superseded").alias("outcome")
    every = (
        sent.select(told)
        .union(superseded.select(told))
        .union(buf.bad_events(flushed).select("reason"))
        .union(flushed.where(buf.bad_event().isNull()).select(untimed).where(untimed.isNotNull()))
    )
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register(
    f"""WITH arrived AS (SELECT *, split_part("key", ' ', 1) AS "eventType",
    split_part("key", ' ', 2) AS id FROM {_RANKED}), last AS (SELECT * FROM arrived QUALIFY row_number()
    OVER (PARTITION BY batch_id, "partition", "key" ORDER BY "offset" DESC) = 1)
    SELECT batch_id AS flush_id, "partition", "eventType", id, upper("value") AS payload,
    row_number() OVER (PARTITION BY batch_id, "partition" ORDER BY "key") AS pos FROM last"""
)
def b8_flush_by_arrival(spark: SparkSession, d: str) -> DataFrame:
    """No lateness rule: an event goes into the flush of the batch it arrived with."""
    rows = batches.assign_batches(event_rows(spark, d, LANES).drop("ts"))
    return buf.buffer_and_sort(rows.withColumnRenamed("batch_id", "flush_id")).drop("key")


# ---- sinks and accounting -------------------------------------------------


@register(
    f"""SELECT "offset", "key", "value", CASE WHEN row_number() OVER (PARTITION BY "key"
    ORDER BY "offset") = 1 THEN 'unique' ELSE 'kickout' END AS outcome FROM {_LOG}"""
)
def k1_committed_output(spark: SparkSession, d: str) -> DataFrame:
    """Two committed runs; both outputs are read back by their markers."""
    job = DedupJob(spark, scratch_path(spark, "output"), seen="ts")
    log = event_log(spark, d)
    job.run(log.where(F.col("ts") < F.lit(MIDWAY).cast("timestamp_ntz")))
    job.run(log)
    sides = [job.output(o).withColumn("outcome", F.lit(o)) for o in ("unique", "kickout")]
    return sides[0].unionByName(sides[1]).select("offset", "key", "value", "outcome")


@register(
    """WITH last AS (SELECT date_trunc('month', o_orderdate) AS flush_id, o_orderstatus AS "eventType",
    CAST(o_custkey AS VARCHAR) AS id, upper(o_orderpriority) AS payload FROM orders QUALIFY row_number()
    OVER (PARTITION BY flush_id, o_orderstatus, o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT *, row_number() OVER (PARTITION BY flush_id ORDER BY "eventType" || ' ' || id) AS pos FROM last"""
)
def k2_sorted_table(spark: SparkSession, d: str) -> DataFrame:
    """Order events arrive as JSON; a flush per month goes to a table and is read back."""
    log = to_records(
        read_table(spark, d, "orders"),
        offset="o_orderkey",
        key=None,
        value=ej.event_json("o_orderstatus", "o_custkey", "o_orderpriority"),
        ts="o_orderdate",
    )
    path = scratch_path(spark, "sorted")
    sort_log(log, F.date_trunc("month", "ts").cast("timestamp_ntz"), path)
    rows = sink.read_flushes(spark, path)
    return rows.select(F.col("flush_id").cast("timestamp_ntz").alias("flush_id"), *buf.EVENT_COLUMNS, "pos")


@register(
    f"""SELECT "partition", "offset", "value", row_number() OVER (PARTITION BY "partition"
    ORDER BY "offset") AS pos FROM (SELECT * FROM {_LANES}
    QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY "offset") = 1)"""
)
def k4_delivery_order(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated records with their place in the order of delivery."""
    firsts = dedup.uniques(dedup.classify(event_log(spark, d, LANES)))
    return with_position(firsts.select("partition", "offset", "value"), ["partition"], ["offset"])


@register(
    f"""SELECT batch_id, "partition", count(*) AS n_in, count(*) FILTER (NOT dup) AS n_unique,
    count(*) FILTER (dup) AS n_dup, max("offset") AS committed_offset FROM (SELECT *,
    "offset" <> min("offset") OVER (PARTITION BY "key") AS dup FROM {_RANKED}) GROUP BY 1, 2"""
)
def m1_batch_accounting(spark: SparkSession, d: str) -> DataFrame:
    rows = batches.assign_batches(event_log(spark, d, LANES).select("partition", "offset", "key"))
    return batch_accounting(dedup.classify(rows), ["batch_id", "partition"]).drop("n_reject")


_QUARTER = "(SELECT CAST(ceil((max(event_id) + 1) / 4) AS BIGINT) FROM events)"


@register(
    f"""SELECT "offset" // {_QUARTER} AS batch_id, count(*) AS n_in, count(*) FILTER (NOT dup) AS n_unique,
    count(*) FILTER (dup) AS n_dup, max("offset") AS committed_offset FROM (SELECT *,
    "offset" <> min("offset") OVER (PARTITION BY "key") AS dup FROM {_LOG}) GROUP BY 1"""
)
def m1_bounded_job_runs(spark: SparkSession, d: str) -> DataFrame:
    """The incremental job in four bounded runs; what its commit markers say."""
    log = event_log(spark, d)
    size = log.select(F.ceil((F.max("offset") + 1) / LANES)).first()[0]
    job = DedupJob(spark, scratch_path(spark, "bounded"), seen="ts")
    while job.run(log, max_offsets=size) is not None:
        pass
    return job.commits().select("batch_id", "n_in", "n_unique", "n_dup", "committed_offset")


# ---- streams --------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = read_table(spark, d, "events").schema
    return stream_files(spark, f"{d}/events.parquet*", schema)


def _log_stream(spark: SparkSession, d: str) -> DataFrame:
    return to_records(
        _event_stream(spark, d), offset="event_id", key=plain_key("event_type", "user_id"), value="props"
    )


def _run_dedup(
    spark: SparkSession, d: str, start: Callable[..., control.StreamingQuery] = sdedup.start_dedup
) -> tuple[str, str, control.StreamingQuery]:
    root, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    return root, checkpoint, control.run_to_end(start(_log_stream(spark, d), root, checkpoint))


def _flagged_output(spark: SparkSession, root: str) -> DataFrame:
    sides = [
        sink.read_output(spark, root, o).withColumn("is_duplicate", F.lit(o == "kickout"))
        for o in ("unique", "kickout")
    ]
    return sides[0].unionByName(sides[1]).select("offset", "key", "value", "is_duplicate")


@register(_FLAGGED)
def d1_stream_classify(spark: SparkSession, d: str) -> DataFrame:
    return _flagged_output(spark, _run_dedup(spark, d)[0])


@register(_FLAGGED)
def d1_stream_classify_keyed_state(spark: SparkSession, d: str) -> DataFrame:
    return _flagged_output(spark, _run_dedup(spark, d, keyed.start_keyed_dedup)[0])


@register(_FLAGGED)
def d6_stream_restarts(spark: SparkSession, d: str) -> DataFrame:
    """The log arrives in two parts; the query is started anew for each."""
    log = event_log(spark, d)
    source, root, checkpoint = (scratch_path(spark, label) for label in ("parts", "stream", "stream-state"))
    half = log.select(F.ceil((F.max("offset") + 1) / 2)).first()[0]
    for part in (F.col("offset") < half, F.col("offset") >= half):
        log.where(part).write.mode("append").parquet(source)
        control.run_to_end(sdedup.start_dedup(stream_files(spark, source, log.schema), root, checkpoint))
    return _flagged_output(spark, root)


@register(_FLAGGED)
def d1_stream_on_registry(spark: SparkSession, d: str) -> DataFrame:
    """Earlier keys are looked up in the bucketed registry: four micro-batches and as many runs."""
    root, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    _run_by_parts(
        spark, event_log(spark, d), lambda rows: sdedup.start_dedup(rows, root, checkpoint, known="registry", seen="ts")
    )
    return _flagged(DedupJob(spark, root)).drop("batch_id")


def _late_by_stream(spark: SparkSession, d: str, before: Callable[[DedupJob, DataFrame], None]) -> DataFrame:
    """The late part of the log through a stream whose root ``before`` has made ready."""
    log = event_log(spark, d, LANES)
    root, source, checkpoint = (scratch_path(spark, label) for label in ("stream", "parts", "stream-state"))
    job = DedupJob(spark, root)
    before(job, log)
    held = job.output().count() + job.output("kickout").count()
    pos.resume_after(log, _midway(log)).write.parquet(source)
    rows = stream_files(spark, source, log.schema)
    control.run_to_end(sdedup.start_dedup(rows, root, checkpoint, known="registry", seen="ts"))
    return _flagged_batch(job, 1 if held else 0)


@register(
    f"""{_EXTENDED} SELECT "offset", "key", "key" IN (SELECT "key" FROM known
    WHERE first_seen >= TIMESTAMP '{PURGE}') OR "offset" <> min("offset") OVER (PARTITION BY "key")
    AS is_duplicate FROM late"""
)
def d10_stream_purged_between_parts(spark: SparkSession, d: str) -> DataFrame:
    """A stream reads the early part, old keys are purged, and a new run reads the rest."""

    def early(job: DedupJob, log: DataFrame) -> None:
        source, checkpoint = scratch_path(spark, "parts"), scratch_path(spark, "stream-state")
        pos.up_to(log, _midway(log)).write.parquet(source)
        rows = stream_files(spark, source, log.schema)
        control.run_to_end(sdedup.start_dedup(rows, job.root, checkpoint, known="registry", seen="ts"))
        job.purge(F.lit(PURGE).cast("timestamp_ntz"))

    return _late_by_stream(spark, d, early)


@register(f"{_EXTENDED} {_LATE}")
def d12_stream_from_backup(spark: SparkSession, d: str) -> DataFrame:
    """A stream begins with the registry and positions that a job backed up."""

    def restored(job: DedupJob, log: DataFrame) -> None:
        old, path = _midway_job(spark, log), scratch_path(spark, "backup")
        reg.backup(old.registry(), path, batch_id=0)
        job.restore(reg.restore(spark, path, batch_id=0), old.positions())

    return _late_by_stream(spark, d, restored)


@register(f'SELECT "key", min("offset") AS first_offset FROM {_LOG} GROUP BY 1')
def d4_stream_registry(spark: SparkSession, d: str) -> DataFrame:
    root, _, _ = _run_dedup(spark, d)
    return sink.read_registry(spark, root, sink.last_batch(spark, root)).select("key", "first_offset")


@register(f'SELECT "key", min("offset") AS first_offset FROM {_LOG} GROUP BY 1')
def d5_live_registry(spark: SparkSession, d: str) -> DataFrame:
    _, checkpoint, _ = _run_dedup(spark, d, keyed.start_keyed_dedup)
    return keyed.live_registry(spark, checkpoint).select("key", "first_offset")


_ALL_IN_ONE = """SELECT "eventType", id, payload, row_number() OVER (ORDER BY sort_key) AS pos FROM
    (SELECT event_type AS "eventType", CAST(user_id AS VARCHAR) AS id, event_type || ' ' || user_id
    AS sort_key, arg_max(upper(props), event_id) AS payload FROM events GROUP BY 1, 2, 3)"""


def _event_row_stream(spark: SparkSession, d: str) -> DataFrame:
    return _event_stream(spark, d).select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("eventType"),
        F.col("user_id").cast("string").alias("id"),
        F.col("props").alias("payload"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@register(_ALL_IN_ONE)
def b2_stream_trigger_flush(spark: SparkSession, d: str) -> DataFrame:
    """The table arrives as one file, so all of it lands in one flush."""
    path, checkpoint = scratch_path(spark, "trigger"), scratch_path(spark, "trigger-state")
    rows = _event_row_stream(spark, d).drop("ts")
    control.run_to_end(sbuf.start_trigger_sort(rows, path, checkpoint, interval=None))
    return sink.read_flushes(spark, path).select(*buf.EVENT_COLUMNS, "pos")


@register(_ALL_IN_ONE)
def b2_stream_wall_clock_flush(spark: SparkSession, d: str) -> DataFrame:
    """The same through the stateful buffer and its timer."""
    path, checkpoint = scratch_path(spark, "flush"), scratch_path(spark, "flush-state")
    query = sbuf.start_buffer_sort(_event_row_stream(spark, d).drop("ts"), path, checkpoint, interval_seconds=2)
    control.run_until(query, lambda: sbuf.drained(query), timeout=600)
    return sink.read_flushes(spark, path).select(*buf.EVENT_COLUMNS, "pos")


@register(
    f"""SELECT flush_id, "eventType", id, payload, row_number() OVER (PARTITION BY flush_id
    ORDER BY sort_key) AS pos FROM {_HOURLY.format(lanes=1)}
    WHERE flush_id + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)"""
)
def b7_stream_event_time_flush(spark: SparkSession, d: str) -> DataFrame:
    """Hourly windows up to the watermark; the last one stays open."""
    path, checkpoint = scratch_path(spark, "window"), scratch_path(spark, "window-state")
    control.run_to_end(sbuf.start_window_sort(_event_row_stream(spark, d), path, checkpoint, "1 hour"))
    start = F.col("flush_start").cast("timestamp").cast("timestamp_ntz")
    return sink.read_flushes(spark, path, "flush_start").select(
        start.alias("flush_id"), *buf.EVENT_COLUMNS, "pos"
    )


def _run_by_parts(
    spark: SparkSession, rows: DataFrame, start: Callable[[DataFrame], control.StreamingQuery], delayed: Column | None = None
) -> None:
    """``rows`` arrive in four parts, each a micro-batch of a query started anew; delayed ones a part later."""
    source = scratch_path(spark, "parts")
    size = rows.select(F.ceil((F.max("offset") + 1) / LANES)).first()[0]
    arrival = F.floor(F.col("offset") / size)
    if delayed is not None:
        arrival = F.least(F.lit(LANES - 1), arrival + delayed.cast("int"))
    for part in range(LANES):
        rows.where(arrival == part).write.mode("append").parquet(source)
        control.run_to_end(start(stream_files(spark, source, rows.schema)))


_ARRIVED = """arrived AS (SELECT event_id, event_type, user_id, CASE WHEN event_id % 17 <> 0 THEN ts END AS ts,
    least(3, event_id // (SELECT CAST(ceil((max(event_id) + 1) / 4) AS BIGINT) FROM events) + CAST(event_id % 13 = 0 AS INT)) AS part
    FROM events), judged AS (SELECT *, CASE WHEN ts IS NULL THEN 'untimed'
    WHEN date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(b.ts) FROM arrived b WHERE b.part < a.part) - INTERVAL 1 DAY THEN 'late'
    WHEN date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM arrived) - INTERVAL 1 DAY THEN 'closed'
    ELSE 'open' END AS outcome FROM arrived a)"""


def _split_windows(spark: SparkSession, d: str) -> str:
    """Daily windows, a day of lateness; each 17th event has no time and each 13th arrives a part later. The root."""
    timed = F.when(F.col("event_id") % 17 != 0, F.col("ts")).cast("timestamp")
    rows = read_table(spark, d, "events").select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("eventType"),
        F.col("user_id").cast("string").alias("id"),
        F.col("props").alias("payload"),
        timed.alias("ts"),
    )
    root, checkpoint = scratch_path(spark, "split"), scratch_path(spark, "split-state")
    _run_by_parts(spark, rows, lambda part: windows.start_window_split(part, root, checkpoint, "1 day", "1 day"), F.col("offset") % 13 == 0)
    return root


@register(f"""WITH {_ARRIVED} SELECT event_id AS "offset", outcome AS reason FROM judged WHERE outcome IN ('late', 'untimed')""")
def b7_stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Late and untimed events, written beside the flushes of the batch they came in."""
    return windows.rejects(spark, _split_windows(spark, d)).select("offset", "reason")


@register(
    f"""WITH {_ARRIVED}, flushed AS (SELECT count(*) AS n FROM (SELECT DISTINCT date_trunc('day', ts), event_type, user_id
    FROM judged WHERE outcome = 'closed')) SELECT outcome, count(*) AS n FROM judged WHERE outcome <> 'closed' GROUP BY 1
    UNION ALL SELECT 'flushed', n FROM flushed
    UNION ALL SELECT 'superseded', count(*) - (SELECT n FROM flushed) FROM judged WHERE outcome = 'closed'
    UNION ALL SELECT 'bad', 0"""
)
def b7_stream_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What became of every event: flushed, superseded, open, late, untimed and bad add up to the input."""
    return windows.outcomes(spark, _split_windows(spark, d))


@register(_FLAGGED)
def d1_stream_parts_keyed_state(spark: SparkSession, d: str) -> DataFrame:
    """Keyed state carried over four micro-batches and as many runs."""
    root, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    _run_by_parts(spark, event_log(spark, d), lambda rows: keyed.start_keyed_dedup(rows, root, checkpoint))
    return _flagged_output(spark, root)


@register(
    f"""SELECT flush_id, "eventType", id, payload, row_number() OVER (PARTITION BY flush_id ORDER BY sort_key) AS pos
    FROM (SELECT event_id // {_QUARTER} AS flush_id, event_type AS "eventType",
    CAST(user_id AS VARCHAR) AS id, event_type || ' ' || user_id AS sort_key,
    arg_max(upper(props), event_id) AS payload FROM events GROUP BY 1, 2, 3, 4)"""
)
def b2_stream_parts_trigger_flush(spark: SparkSession, d: str) -> DataFrame:
    """Four micro-batches, each one flush."""
    path, checkpoint = scratch_path(spark, "trigger"), scratch_path(spark, "trigger-state")
    _run_by_parts(
        spark,
        event_rows(spark, d).drop("ts"),
        lambda rows: sbuf.start_trigger_sort(rows, path, checkpoint, interval=None),
    )
    return sink.read_flushes(spark, path).select("flush_id", *buf.EVENT_COLUMNS, "pos")


@register(_ALL_IN_ONE)
def b6_stopped_buffer(spark: SparkSession, d: str) -> DataFrame:
    """The buffer is stopped once it holds the events, and flushes them after a restart."""
    path, checkpoint = scratch_path(spark, "flush"), scratch_path(spark, "flush-state")
    interval = 20

    def run(done: Callable[[int], bool]) -> None:
        rows = _event_row_stream(spark, d).drop("ts")
        query = sbuf.start_buffer_sort(rows, path, checkpoint, interval_seconds=interval)
        control.run_until(query, lambda: any(done(s.numRowsTotal) for p in query.recentProgress for s in p.stateOperators), timeout=600)

    # half an interval or more is left until the flush
    control.wait_for(lambda: time.time() % interval < interval / 2)
    run(lambda held: held > 0)
    run(lambda held: held == 0)
    return sink.read_flushes(spark, path).select(*buf.EVENT_COLUMNS, "pos")


def _dedup_by_parts(
    spark: SparkSession, d: str, *logs: Callable[[str, str], monitor.StreamingQueryListener], known: str = "counts"
) -> list[str]:
    """The log arrives in four parts, each a micro-batch of a query started anew.

    ``logs`` make listeners from (path, root); their tables' paths are returned, once
    they have a row for each part: events of a query arrive after it ended.
    """
    log = event_log(spark, d)
    source, root, checkpoint = (scratch_path(spark, label) for label in ("parts", "stream", "stream-state"))
    size = log.select(F.ceil((F.max("offset") + 1) / LANES)).first()[0]
    paths = [scratch_path(spark, "progress") for _ in logs]
    with monitor.logged(spark, *[make(path, root) for make, path in zip(logs, paths)]):
        for part in range(LANES):
            log.where(F.floor(F.col("offset") / size) == part).write.mode("append").parquet(source)
            rows = stream_files(spark, source, log.schema)
            control.run_to_end(sdedup.start_dedup(rows, root, checkpoint, query_name=_QUERY_NAME, known=known))
        control.wait_for(lambda: all(_parts_logged(spark, path) == LANES for path in paths))
    return paths


_QUERY_NAME = "siftline_dedup"


def _parts_logged(spark: SparkSession, path: str) -> int:
    batch = T.StructType([T.StructField("batch_id", T.LongType())])
    return sink.read_or_empty(spark, path, batch).distinct().count()


@register(
    f"""SELECT "offset" // {_QUARTER} AS batch_id, count(*) AS input_rows, '{_QUERY_NAME}' AS name
    FROM {_LOG} GROUP BY 1"""
)
def m2_commit_log(spark: SparkSession, d: str) -> DataFrame:
    """The commit log of a named dedup stream over four micro-batches and as many runs."""
    made = lambda path, root: monitor.CommitLog(spark, path, _QUERY_NAME, root)
    (path,) = _dedup_by_parts(spark, d, made)
    return spark.read.parquet(path).select("batch_id", "input_rows", "name")


@register(f"""SELECT "offset" // {_QUARTER} AS batch_id, count(*) AS input_rows FROM {_LOG} GROUP BY 1""")
def m2_rows_read_once(spark: SparkSession, d: str) -> DataFrame:
    """Spark's own count of input rows, of a stream on the registry over four micro-batches."""
    (path,) = _dedup_by_parts(
        spark, d, lambda path, root: monitor.CommitLog(spark, path, _QUERY_NAME), known="registry"
    )
    return spark.read.parquet(path).where("input_rows > 0").select("batch_id", "input_rows")


@register(
    f"""WITH r AS (SELECT "offset" // {_QUARTER} AS b, row_number() OVER (PARTITION BY "key"
    ORDER BY "offset") = 1 AS new FROM {_LOG}), n AS (SELECT b, count(*) FILTER (new) AS n FROM r GROUP BY 1)
    SELECT b AS batch_id, CAST(sum(n) OVER (ORDER BY b) AS BIGINT) AS state_rows, CAST(1 AS BIGINT) AS runs FROM n"""
)
def m3_state_report(spark: SparkSession, d: str) -> DataFrame:
    """Entries in the state after each part; from the second on, restored ones included."""
    (path,) = _dedup_by_parts(spark, d, lambda path, root: monitor.StateLog(spark, path, _QUERY_NAME))
    return (
        spark.read.parquet(path)
        .groupBy("batch_id")
        .agg(F.sum("state_rows").alias("state_rows"), F.count_distinct("run_id").alias("runs"))
    )


@register(
    f"""WITH half AS (SELECT "key", "offset" < (SELECT ceil((max("offset") + 1) / 2) FROM {_LOG}) AS early FROM {_LOG})
    SELECT * FROM (SELECT CAST(0 AS BIGINT) AS newest_batch, count(DISTINCT "key") AS entries, CAST(0 AS BIGINT) AS partitions_off
    FROM half WHERE early UNION ALL SELECT 1, count(DISTINCT "key"), 0 FROM half)"""
)
def m3_restored_partitions(spark: SparkSession, d: str) -> DataFrame:
    """State entries of each partition after two runs, against the partition that each key hashes to."""
    log = event_log(spark, d)
    source, root, checkpoint = (scratch_path(spark, label) for label in ("parts", "stream", "stream-state"))
    half = log.select(F.ceil((F.max("offset") + 1) / 2)).first()[0]
    out = None
    for batch, part in enumerate((F.col("offset") < half, F.col("offset") >= half)):
        log.where(part).write.mode("append").parquet(source)
        control.run_to_end(sdedup.start_dedup(stream_files(spark, source, log.schema), root, checkpoint))
        state = monitor.restored_state(spark, checkpoint)
        n = state.count()
        keys = log.where(F.col("offset") < half) if batch == 0 else log
        own = F.pmod(F.hash("key"), F.lit(n)).alias("partition")
        wanted = keys.select("key").distinct().groupBy(own).agg(F.count(F.lit(1)).alias("wanted"))
        told = state.join(wanted, "partition", "left").agg(
            F.max("newest_batch").alias("newest_batch"),
            F.sum("entries").alias("entries"),
            F.count_if(F.col("entries") != F.coalesce("wanted", F.lit(0))).alias("partitions_off"),
        )
        # settled, as the second run adds to the state
        out = settle(told) if out is None else out.unionByName(told)
    return out
