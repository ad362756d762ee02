"""Joins for skewed sides, and the size check before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# A table is broadcast by hint only up to this measured size.
BROADCAST_BYTES = 32 << 20


def fits_broadcast(table: DataFrame) -> bool:
    """Measure a settled table: all values as text, plus an allowance per row."""
    row = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in table.columns])) + 64
    return (table.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES


def free_name(base: str, *tables: DataFrame) -> str:
    """A column name like ``base`` that none of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while base.lower() in taken:
        base += "_"
    return base


def join_skewed(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join a left side with hot keys to a right side that holds each key once.

    The adaptive engine splits a skewed left partition only if both sides come
    straight from a shuffle; a right side that an aggregate has already
    partitioned by the same keys would rule that out. The hash as additional
    join key makes both sides shuffle for the join, and makes comparing keys in
    the sort cheap. A right side small enough is broadcast by the engine as usual.
    """
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"{k} has different types on the two sides")
    name = free_name("_hash", left, right)
    hashed = F.xxhash64(*keys).alias(name)
    joined = left.select(hashed, "*").join(right.select(hashed, "*"), [name, *keys], how)
    kept = [c for c in right.columns if c not in left.columns] if how in ("left", "inner") else []
    return joined.select(*left.columns, *kept)
