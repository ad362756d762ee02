"""Events from and to JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import EVENT, EVENT_TYPES
from .events import is_known_type

_PARSED = T.StructType([*EVENT.fields, T.StructField("_corrupt_record", T.StringType())])


def _is_nested(value: str, field: str) -> Column:
    """Whether a text field holds an object or array, which is no text.

    The parser hands such a value over as its JSON text. Only texts that begin
    like one are looked at again.
    """
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(F.col(value)), f"$.{field}", "variant"))
    suspect = F.substring(F.col(f"_event.{field}"), 1, 1).isin("{", "[")
    return F.when(suspect, ~kind.eqNullSafe("STRING")).otherwise(F.lit(False))


def parse_events(
    records: DataFrame,
    value: str = "value",
    domain: Sequence[str] = EVENT_TYPES,
    on_error: str = "reject",
) -> DataFrame:
    """Add ``eventType``, ``id``, ``payload`` and a ``reason`` for unusable rows.

    The reason is null for good events. ``on_error='fail'`` makes the running
    job raise instead. Unknown fields are ignored.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")
    event = F.from_json(F.col(value), _PARSED, {"columnNameOfCorruptRecord": "_corrupt_record"})
    # As a generated column the event is parsed once; a plain one would be copied
    # into every filter on its fields.
    parsed = records.select("*", F.explode(F.array(event)).alias("_event"))
    is_null = F.col(value).isNull() | (F.trim(F.col(value)).isin("", "null"))
    reason = (
        F.when(is_null, "null value")
        .when(F.col("_event").isNull() | F.col("_event._corrupt_record").isNotNull(), "malformed json")
        .when(_is_nested(value, "id") | _is_nested(value, "payload"), "malformed json")
        .when(F.col("_event.eventType").isNull(), "missing event type")
        .when(~is_known_type(F.col("_event.eventType"), domain), "unknown event type")
        .when(F.col("_event.payload").isNull(), "missing payload")
    )
    if on_error == "fail":
        reason = F.when(
            reason.isNotNull(), F.raise_error(F.concat(F.lit("bad event: "), reason)).cast("string")
        )
    fields = [F.col(f"_event.{f.name}").alias(f.name) for f in EVENT.fields]
    return parsed.select(*records.columns, *fields, reason.alias("reason"))


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason")


def event_rejects(parsed: DataFrame) -> DataFrame:
    """Unusable rows with their reason; the event columns are left out."""
    return parsed.where(F.col("reason").isNotNull()).drop(*EVENT.fieldNames())


def event_json(
    event_type: Column | str = "eventType", event_id: Column | str = "id", payload: Column | str = "payload"
) -> Column:
    """The event as a JSON object; null fields are left out."""
    named = []
    for name, col in (("eventType", event_type), ("id", event_id), ("payload", payload)):
        picked = F.col(col) if isinstance(col, str) else col
        named.append(picked.cast("string").alias(name))
    return F.to_json(F.struct(*named))
