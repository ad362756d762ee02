"""Schemas and fixed domains of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("eventType", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("first_seen", T.TimestampType()),
    ]
)

COMMITTED = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# The event type symbols in declaration order.
EVENT_TYPES = (
    "START",
    "A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "K", "L", "M", "N", "O", "P",
    "STOP",
)

# The symbols that carry no event.
CONTROL_TYPES = ("START", "STOP")
