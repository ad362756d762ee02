"""Choosing the dedup key and dealing with rows that have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NULL_KEY_POLICIES = ("reject", "fail")


def plain_key(*cols: Column | str, sep: str = " ") -> Column:
    """Readable key: the columns joined with ``sep``; null if any part is null."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.concat(*parts)


def hashed_key(*cols: Column | str) -> Column:
    """Fixed-width key for wide columns such as whole texts.

    One column is hashed as it is. Several are hashed as a JSON object, whose
    quoting keeps ('a', 'bc') and ('ab', 'c') apart.
    """
    picked = [F.col(c) if isinstance(c, str) else c for c in cols]
    if len(picked) == 1:
        return F.sha2(picked[0].cast("string"), 256)
    named = [c.cast("string").alias(f"k{i}") for i, c in enumerate(picked)]
    return F.sha2(F.to_json(F.struct(*named)), 256)


def with_key(table: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Add a key that is costly to compute, such as the hash of a whole text.

    As a generated column it is computed once per row; a plain one would be
    computed again in every null check that the optimizer pushes to the scan.
    """
    return table.select("*", F.explode(F.array(key)).alias(name))


def guard_key(records: DataFrame, on_null_key: str = "reject", key: str = "key") -> DataFrame:
    """Apply the null key policy.

    ``reject`` leaves the rows in place, and the dedup operators give them no
    verdict. ``fail`` makes the running job raise on the first one.
    """
    if on_null_key not in NULL_KEY_POLICIES:
        raise ValueError(f"on_null_key must be one of {NULL_KEY_POLICIES}")
    if on_null_key == "reject":
        return records
    checked = F.when(
        F.col(key).isNull(), F.raise_error(F.lit(f"record without a {key}")).cast("string")
    ).otherwise(F.col(key))
    return records.withColumn(key, checked)


def null_key_rejects(records: DataFrame, key: str = "key") -> DataFrame:
    """The rows that have no key, with the reason."""
    return records.where(F.col(key).isNull()).withColumn("reason", F.lit("null key"))
