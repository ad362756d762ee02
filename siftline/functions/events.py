"""Column expressions and row filters on events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import CONTROL_TYPES, EVENT_TYPES


def upper_payload(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Upper-case the payload; the other columns stay as they are."""
    return events.withColumn(payload, F.upper(payload))


def sort_key(event_type: Column | str = "eventType", event_id: Column | str = "id") -> Column:
    """``<type> <id>``; a missing id reads ``null``, a missing type gives no key."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    ident = F.col(event_id) if isinstance(event_id, str) else event_id
    return F.concat(kind, F.lit(" "), F.coalesce(ident.cast("string"), F.lit("null")))


def is_known_type(event_type: Column | str = "eventType", domain: Sequence[str] = EVENT_TYPES) -> Column:
    """True if the type is in the domain; false, never null, for a missing one."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.coalesce(kind.isin(*domain), F.lit(False))


def type_ordinal(event_type: Column | str = "eventType", domain: Sequence[str] = EVENT_TYPES) -> Column:
    """Position of the type in the domain from 0; null when it is not in it."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    found = F.array_position(F.array(*[F.lit(d) for d in domain]), kind)
    return F.nullif(found, F.lit(0).cast("bigint")) - 1


def without_control_types(
    events: DataFrame, event_type: str = "eventType", control: Sequence[str] = CONTROL_TYPES
) -> DataFrame:
    """Drop the control symbols; rows without a type stay for the domain check."""
    return events.where(F.col(event_type).isNull() | ~F.col(event_type).isin(*control))


def without_tombstones(rows: DataFrame, value: str = "value") -> DataFrame:
    """Drop rows whose value is null."""
    return rows.where(F.col(value).isNotNull())


def value_only(records: DataFrame, value: str = "value") -> DataFrame:
    """Keep the value, drop the key."""
    return records.select(value)


def with_null_key(rows: DataFrame, key: str = "key") -> DataFrame:
    """Put a null key in front of the row."""
    rest = [F.col(c) for c in rows.columns if c != key]
    return rows.select(F.lit(None).cast("string").alias(key), *rest)


def same_event(left: str, right: str) -> Column:
    """Field by field equality of two event structs, where null equals null."""
    return F.col(left).eqNullSafe(F.col(right))


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per event, whole rows compared null-safely."""
    return events.dropDuplicates()
