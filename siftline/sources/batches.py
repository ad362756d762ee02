"""Splitting a log into bounded batches, and reading committed ones only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import join_skewed
from ..operators.ranking import with_position

DEFAULT_BATCH = 1000


def assign_batches(records: DataFrame, size: int = DEFAULT_BATCH) -> DataFrame:
    """Add ``batch_id``: ``size`` consecutive offsets of a source partition each.

    Offsets have gaps, so the id comes from the rank of the offset and not from
    its value. Ranking works on the distinct positions alone; copies of one
    record therefore share a batch, and wide rows are shuffled once, by
    position.
    """
    if size < 1:
        raise ValueError("size must be positive")
    places = records.select("partition", "offset").distinct()
    ranked = with_position(places, groups=["partition"], order=["offset"], name="_rank")
    ids = ranked.select("partition", "offset", F.expr(f"(_rank - 1) div {size}").alias("batch_id"))
    return records.join(ids, ["offset", "partition"]).select(*records.columns, "batch_id")


def read_committed(rows: DataFrame, commits: DataFrame, on: str | list[str] = "batch_id") -> DataFrame:
    """Only rows whose batch has a commit marker."""
    keys = [on] if isinstance(on, str) else on
    return join_skewed(rows, commits.select(*keys), keys, "left_semi")
