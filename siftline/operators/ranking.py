"""Exact positions inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import scratch_path, settle
from .joins import fits_broadcast


def with_position(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Add the 1-based position of each row in its group, in ``order``.

    ``row_number`` would sort a whole group in one task, and one group may hold
    a third of all rows. Here the rows are range-partitioned by group and order
    instead, so a large group spans many tasks. Each task numbers its sorted
    rows, and a table with one row per (group, block) says how many rows of the
    group lie in earlier blocks. The rows must be unique by group and order.

    The checkpoint keeps the block numbers the same for both uses of the rows.
    The small table is broadcast if its measured size allows; otherwise both sides
    are shuffled by (block, group), which a large group does not unbalance.
    """
    return _placed(settle(_numbered(df, groups, order)), df.columns, groups, name)


def with_stored_position(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """:func:`with_position` for wide rows.

    A checkpoint would hold whole rows, and be read whole twice. The sorted blocks are written
    as Parquet to the shared folder instead: the block sizes come from the group columns and
    the row number alone, and the wide columns are read once.
    """
    path = scratch_path(df.sparkSession, "blocks")
    numbered = _numbered(df, groups, order)
    numbered.write.parquet(path)
    return _placed(df.sparkSession.read.schema(numbered.schema).parquet(path), df.columns, groups, name)


def _numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sorted blocks with ``_row``, whose upper bits are the block."""
    if not groups:
        raise ValueError("at least one group column is needed")
    keys = [*groups, *order]
    return (
        df.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
    )


def _placed(numbered: DataFrame, columns: Sequence[str], groups: Sequence[str], name: str) -> DataFrame:
    block = F.shiftrightunsigned("_row", 33)
    earlier = W.partitionBy(*groups).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = settle(
        numbered.groupBy(*groups, block.alias("_block"))
        .agg(F.min("_row").alias("_low"), F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(g).alias(f"_g_{g}") for g in groups],
            F.col("_block").alias("_b"),
            (F.col("_low") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - 1).alias("_base"),
        )
    )
    if fits_broadcast(starts):
        starts = F.broadcast(starts)
    same = block == F.col("_b")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return numbered.join(starts, same).select(*columns, (F.col("_row") - F.col("_base")).alias(name))
