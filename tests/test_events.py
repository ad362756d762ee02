import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siftline.functions import event_json as ej, events as ev
from siftline.schemas import EVENT, EVENT_TYPES


def make(spark, *rows):
    return spark.createDataFrame(rows, EVENT)


def parse(spark, *texts, **kwargs):
    records = spark.createDataFrame(list(enumerate(texts)), "offset bigint, value string")
    return ej.parse_events(records, **kwargs)


def test_upper_payload_is_unicode_aware(spark):
    row = ev.upper_payload(make(spark, ("A", "id x", "straße é"))).first()
    assert tuple(row) == ("A", "id x", "STRASSE É")


def test_null_id_reads_null_in_the_sort_key(spark):
    rows = make(spark, ("A", None, "x"), ("A", "7", "x"), (None, "7", "x"))
    assert [r[0] for r in rows.select(ev.sort_key()).collect()] == ["A null", "A 7", None]


def test_domain_and_ordinal(spark):
    rows = make(spark, ("START", "", ""), ("P", "", ""), ("STOP", "", ""), ("ZZ", "", ""), (None, "", ""))
    got = rows.select(ev.is_known_type(), ev.type_ordinal()).collect()
    assert [tuple(r) for r in got] == [(True, 0), (True, 16), (True, 17), (False, None), (False, None)]
    assert len(EVENT_TYPES) == 18


def test_control_types_are_skipped(spark):
    rows = make(spark, *[(t, "1", "x") for t in EVENT_TYPES], (None, "1", "x"))
    kept = [r["eventType"] for r in ev.without_control_types(rows).collect()]
    assert kept == [*"ABCDEFGHIJKLMNOP", None]


def test_tombstones_and_keys(spark):
    rows = spark.createDataFrame([("k", "v"), ("k", None)], "key string, value string")
    assert [tuple(r) for r in ev.with_null_key(ev.without_tombstones(rows)).collect()] == [(None, "v")]
    assert ev.value_only(rows).columns == ["value"]


def test_events_are_compared_field_by_field(spark):
    rows = make(spark, ("A", None, "x"), ("A", None, "x"), ("A", "1", "x"), (None, None, None), (None, None, None))
    assert ev.distinct_events(rows).count() == 3
    pair = rows.select(F.struct("*").alias("l")).crossJoin(make(spark, ("A", None, "x")).select(F.struct("*").alias("r")))
    assert [r[0] for r in pair.select(ev.same_event("l", "r")).collect()] == [True, True, False, False, False]


def test_good_events_parse(spark):
    parsed = parse(
        spark,
        '{"eventType":"A","id":"1","payload":"x"}',
        '{"payload":"y","eventType":"STOP","more":[1,2]}',
        '{"eventType":"B","id":12,"payload":true}',
    )
    got = [tuple(r)[2:] for r in ej.good_events(parsed).orderBy("offset").collect()]
    assert got == [("A", "1", "x"), ("STOP", None, "y"), ("B", "12", "true")]
    assert ej.event_rejects(parsed).count() == 0


def test_bad_json_is_rejected_with_a_reason(spark):
    parsed = parse(
        spark, "{bad", "null", None, "", " ", '{"eventType":"ZZ","payload":"x"}', '{"eventType":"A"}',
        '{"payload":"x"}', "[1]", "7", '"text"',
    )
    assert ej.good_events(parsed).count() == 0
    assert [r["reason"] for r in ej.event_rejects(parsed).orderBy("offset").collect()] == [
        "malformed json", "null value", "null value", "null value", "null value", "unknown event type",
        "missing payload", "missing event type", "malformed json", "malformed json", "malformed json",
    ]
    assert ej.event_rejects(parsed).columns == ["offset", "value", "reason"]


def test_nested_values_are_no_text(spark):
    parsed = parse(
        spark, '{"eventType":"A","id":{"x":1},"payload":"p"}', '{"eventType":"A","id":"1","payload":[1]}',
        '{"eventType":"A","id":"{1}","payload":"[x"}',
    )
    assert [r["reason"] for r in parsed.orderBy("offset").collect()] == ["malformed json", "malformed json", None]


def test_bad_json_can_fail_the_batch(spark):
    with pytest.raises(PySparkException, match="bad event: malformed json"):
        ej.good_events(parse(spark, "{bad", on_error="fail")).collect()


def test_json_round_trip(spark):
    rows = make(spark, ("A", "1", 'say "<&=\'>" \\ ü\n'), ("B", None, "x"))
    text = rows.select(ej.event_json().alias("value"))
    assert text.collect()[1][0] == '{"eventType":"B","payload":"x"}'
    back = ej.good_events(ej.parse_events(text)).drop("value")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_json_with_escapes_of_other_writers(spark):
    parsed = parse(spark, '{"eventType":"A","id":"1","payload":"\\u003cb\\u003e \\u0026 \\u0027"}')
    assert ej.good_events(parsed).first()["payload"] == "<b> & '"
