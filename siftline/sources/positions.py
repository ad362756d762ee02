"""Start positions per source partition: resume, replay and the reset policy.

Positions travel as a small dict ``{partition: offset}``, one entry per source
partition. They are joined to the records as a table, and what holds for all of them,
the lowest start or the highest end, reaches the parquet scan as a filter.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

RESET_POLICIES = ("earliest", "latest", "none")

# Up to so many entries, of 16 bytes each, the position table is sent to all tasks.
_BROADCAST_ENTRIES = 1 << 20


class OffsetOutOfRange(ValueError):
    """A start position lies outside the log and the policy is ``none``."""


def collect_positions(positions: DataFrame) -> dict[int, int]:
    """``partition, offset`` rows as a dict."""
    return {r["partition"]: r["offset"] for r in positions.select("partition", "offset").collect()}


def last_positions(records: DataFrame) -> DataFrame:
    """The highest offset per source partition: the last one processed, not the next."""
    return records.groupBy("partition").agg(F.max("offset").alias("offset"))


def starting_offsets_json(topic: str, positions: dict[int, int]) -> str:
    """``startingOffsets`` for the Kafka source; ``positions`` are the first offsets to read."""
    return json.dumps({topic: {str(p): o for p, o in sorted(positions.items())}})


def _with_position(records: DataFrame, positions: dict[int, int], how: str) -> DataFrame:
    """Add ``_at``, the position of the row's partition."""
    kind = records.schema["partition"].dataType.simpleString()
    table = records.sparkSession.createDataFrame(list(positions.items()), f"_of {kind}, _at long")
    if len(positions) <= _BROADCAST_ENTRIES:
        table = F.broadcast(table)
    return records.join(table, F.col("partition") == F.col("_of"), how)


def replay_from(records: DataFrame, positions: dict[int, int]) -> DataFrame:
    """All records at or after the chosen offsets; other partitions in full."""
    if not positions:
        return records
    listed = F.col("partition").isin(*positions)
    within = records.where((F.col("offset") >= min(positions.values())) | ~listed)
    placed = _with_position(within, positions, "left")
    return placed.where(F.col("_at").isNull() | (F.col("offset") >= F.col("_at"))).drop("_of", "_at")


def up_to(records: DataFrame, positions: dict[int, int]) -> DataFrame:
    """All records at or before the positions; nothing of other partitions."""
    if not positions:
        return records.where(F.lit(False))
    within = records.where(F.col("offset") <= max(positions.values()))
    return _with_position(within, positions, "inner").where(F.col("offset") <= F.col("_at")).drop("_of", "_at")


def resume_after(records: DataFrame, committed: dict[int, int]) -> DataFrame:
    """First run: everything. Later: from committed + 1 in each source partition."""
    return replay_from(records, {p: o + 1 for p, o in committed.items()})


def next_batch(records: DataFrame, committed: dict[int, int], max_offsets: int) -> DataFrame:
    """What follows the committed positions, at most ``max_offsets`` records per source partition.

    Offsets serve as a bound only: with gaps there are fewer records, but never
    none, because each stretch begins at a record.
    """
    if max_offsets < 1:
        raise ValueError("max_offsets must be positive")
    fresh = resume_after(records, committed)
    starts = collect_positions(fresh.groupBy("partition").agg(F.min("offset").alias("offset")))
    return up_to(fresh, {p: o + max_offsets - 1 for p, o in starts.items()})


def start_at(records: DataFrame, positions: dict[int, int], policy: str = "none") -> DataFrame:
    """Replay with a rule for positions that are not in the log.

    A position is in range from the lowest offset up to one past the highest.
    ``earliest`` reads such a partition from its beginning, ``latest`` reads
    none of its present rows, ``none`` raises.
    """
    if policy not in RESET_POLICIES:
        raise ValueError(f"policy must be one of {RESET_POLICIES}")
    if not positions:
        return records
    bounds = (
        records.where(F.col("partition").isin(*positions))
        .groupBy("partition")
        .agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
        .collect()
    )
    ranges = {r["partition"]: (r["low"], r["high"] + 1) for r in bounds}
    resolved: dict[int, int] = {}
    for part, offset in positions.items():
        # the log has no row of a partition that is not listed
        low, end = ranges.get(part, (0, 0))
        if low <= offset <= end:
            resolved[part] = offset
        elif policy == "none":
            raise OffsetOutOfRange(f"partition {part}: offset {offset} not in [{low}, {end}]")
        else:
            resolved[part] = low if policy == "earliest" else end
    return replay_from(records, resolved)


def assert_single_partition(records: DataFrame) -> DataFrame:
    """Raise unless all rows come from one source partition."""
    found = records.select(F.min("partition").alias("low"), F.max("partition").alias("high")).first()
    if found["low"] != found["high"]:
        raise ValueError(
            f"expected one source partition, found {found['low']} to {found['high']}"
        )
    return records
