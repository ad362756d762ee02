"""Shards balanced in bytes, tokens and rows by vector bin packing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import with_position
from .tables import n_words_of, stored, text_of

# Groups of equal texts above 1 / (shards * GRAIN) of a total are placed one by one;
# smaller ones travel in shards * GRAIN bundles. This bounds what the driver sees
# to 4 * shards * GRAIN rows, whatever the number of documents.
GRAIN = 256
LAW = "bytes"


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, for items of (bytes, tokens, rows).

    Items go from the largest to the smallest. Each goes where the dot product of
    its vector with the shard's residual capacity is highest, among the shards
    that have room for it in bytes; if none has, where most bytes are left. A tie
    goes to the lowest shard.
    """
    totals = np.maximum(vectors.sum(axis=0), 1)
    items = vectors / totals * shards
    room = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -items[:, 0])):
        fit = room[:, 0] >= items[i, 0]
        best = int(np.argmax(np.where(fit, room @ items[i], -np.inf))) if fit.any() else int(np.argmax(room[:, 0]))
        out[i] = best
        room[best] -= items[i]
    return out


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Rows with equal texts form a group and share a shard; a null text counts as
    empty. A group beyond the capacity of a shard cannot stay whole: its rows are dealt
    into pieces in turn, also where they have one id or none. Groups are weighed by partial aggregates, so a hot
    group is a few rows in the shuffle. ``slot`` numbers a shard's rows from 0, by
    group and id. The law is ``bytes``: sizes are near equal, so ``grown_shard`` is null.
    An empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    t = text_of(text)
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(t) + 8).cast("long").alias("size"),
            F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
            F.md5(F.encode(t, "UTF-8")).alias("_group"),
            n_words_of(t).alias("_tokens"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sharding",
    )
    total = rows.agg(F.sum("size"), F.sum("_tokens"), F.count(F.lit(1))).first()
    capacity = max(1, (total[0] or 0) // shards)
    bundles = shards * GRAIN
    weights = stored(
        rows.groupBy("_group").agg(
            F.sum("size").alias("b"), F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("r")
        ),
        "groups",
    )
    large = F.lit(False)
    for name, whole in zip("btr", total):
        large = large | (F.col(name) * bundles > F.lit(whole or 0))
    pieces = F.ceil(F.col("b") / F.lit(capacity)).cast("int")
    heavy = weights.filter(large).select("_group", pieces.alias("_pieces"))
    # at most 3 * bundles groups exceed 1 / bundles of one of three totals
    heavy = F.broadcast(heavy)
    named = rows.join(heavy, "_group", "left").withColumn(
        "_item",
        F.when(F.col("_pieces").isNull(), F.concat(F.lit("bundle "), F.pmod(F.xxhash64("_group"), F.lit(bundles))))
        .when(F.col("_pieces") <= 1, F.col("_group"))
        .otherwise(
            F.concat_ws(" ", "_group", F.pmod("_row", F.col("_pieces").cast("long")))
        ),
    )
    items = named.groupBy("_item").agg(F.sum("size"), F.sum("_tokens"), F.count(F.lit(1))).orderBy("_item").collect()
    vectors = np.array([tuple(r)[1:] for r in items], dtype=float).reshape(len(items), 3)
    where = spark.createDataFrame(
        [(r["_item"], int(s)) for r, s in zip(items, place(vectors, shards))], "_item string, shard int"
    )
    placed = named.join(F.broadcast(where), "_item").withColumn("_tie", F.monotonically_increasing_id())
    return with_position(
        placed.select("doc_id", "size", "text_crc32", "_group", "shard", "_tie"),
        ["shard"],
        ["_group", "doc_id", "_tie"],
        "_slot",
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("_slot") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
