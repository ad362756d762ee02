"""Per-batch numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def batch_accounting(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Records in, passed, kicked out, without key, and the position reached.

    A position belongs to a source partition; name it in ``by`` for a log with
    several of them.
    """
    return flagged.groupBy(*(by or ["batch_id"])).agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(~F.col("is_duplicate")).alias("n_unique"),
        F.count_if(F.col("is_duplicate")).alias("n_dup"),
        F.count_if(F.col("is_duplicate").isNull()).alias("n_reject"),
        F.max("offset").alias("committed_offset"),
    )
