"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import join_skewed
from ..operators.ranking import with_position
from .tables import n_words_of, stored, text_of

# No source is taken more often than this many times its own size.
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 42
# Expected copies are kept as whole numbers of 1/_UNIT, so that sums are exact.
_UNIT = 1 << 20


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``_source, source_size, target`` per source from ``_source, size`` rows.

    Sources in code point order, null last, weigh as ``weights`` repeats. They share
    the sum of all sizes by weight; a source stops at ``max_repeats`` times its
    size, and the excess is shared again by weight. With a fill level, a target
    is min(cap, weight * level); the level rises until no further source is capped,
    which takes at most one round per source and mostly two or three.
    """
    per_source = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = stored(
        with_position(
            per_source.select(
                F.lit(0).alias("_all"),
                F.col("_source").isNull().alias("_none"),
                # UTF-8 bytes sort like code points
                F.coalesce(F.encode("_source", "UTF-8"), F.lit(b"")).alias("_order"),
                "_source",
                "source_size",
            ),
            ["_all"],
            ["_none", "_order"],
            "_rank",
        ).select(
            "_source",
            "source_size",
            F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("long").alias("_weight"),
        ),
        "targets",
    )
    cap = F.col("source_size") * max_repeats
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_capped = 0.0, -1
    while True:
        open_ = cap > F.col("_weight") * F.lit(level)
        row = ranked.agg(
            F.sum(F.when(~open_, cap)).alias("capped"),
            F.sum(F.when(open_, F.col("_weight"))).alias("weight"),
            F.sum((~open_).cast("long")).alias("n"),
        ).first()
        if not row["weight"] or row["n"] == n_capped:
            break
        n_capped, level = row["n"], (total - (row["capped"] or 0)) / row["weight"]
    return ranked.select(
        "_source", "source_size", F.least(cap.cast("double"), F.col("_weight") * F.lit(level)).alias("target")
    )


def copies_of(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """Add ``source_size, target, copies`` to rows of ``_id, _source, size``.

    A document of a source is expected target / source_size times. Running through
    a source from its largest document to its smallest, ties by id, these
    expectations are summed up, one random offset of the source is added, and a
    document is emitted once for each whole number its sum crosses. The order by
    size keeps the words taken within about one document of the target.
    """
    goal = targets(sizes, weights, max_repeats)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    steps = goal.withColumn("_step", F.floor(rate * _UNIT).cast("long")).withColumn(
        "_offset", F.pmod(F.xxhash64(F.lit(seed), F.coalesce("_source", F.lit(""))), F.lit(_UNIT))
    )
    # a tie-breaker by row, so that repeated rows have places of their own
    placed = with_position(
        stored(
            sizes.withColumn("_down", -F.col("size"))
            .withColumn("_mix", F.xxhash64(F.lit(seed), "_id"))
            .withColumn("_tie", F.monotonically_increasing_id()),
            "mixing",
        ),
        ["_source"],
        ["_down", "_mix", "_id", "_tie"],
        "_rank",
    )

    keyed = placed.withColumn("_key", F.to_json(F.struct("_source"))).drop("_down", "_mix", "_tie")
    by_source = steps.withColumn("_key", F.to_json(F.struct("_source"))).drop("_source")
    return (
        join_skewed(keyed, by_source, ["_key"], "inner")
        .withColumn(
            "copies",
            (
                F.expr(f"(_offset + _rank * _step) div {_UNIT}") - F.expr(f"(_offset + (_rank - 1) * _step) div {_UNIT}")
            ).cast("long"),
        )
        .drop("_key", "_rank", "_step", "_offset")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    row: str | None = None,
) -> DataFrame:
    """How often each document is taken: ``doc_id, size, source_size, target, taken, copies``.

    ``row`` names a column to hand on as ``row``, which tells apart rows that repeat an id.

    A null text has size 0, rows without a source form a source of their own,
    repeated rows are sampled each for itself, an empty table gives no rows, and
    other columns are left out. A source without words has target 0 and no copies.
    Reruns give the same rows.
    """
    sizes = stored(
        docs.select(
            F.col(id_col).alias("_id"), F.col(source).alias("_source"), n_words_of(text_of(text)).alias("size"),
            *([] if row is None else [F.col(row).alias("_given")]),
        ),
        "sizes",
    )
    return copies_of(sizes, weights, max_repeats, seed).select(
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        *([] if row is None else [F.col("_given").alias("row")]),
    )
