"""Connected components of a graph given as links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import join_skewed
from .tables import stored


def follow(parents: DataFrame) -> DataFrame:
    """Point every id at the end of its chain of smaller parents, doubling the reach per round."""
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("_next"))
        jumped = stored(
            join_skewed(parents, above, ["parent"], "left").select(
                "id",
                F.coalesce("_next", "parent").alias("parent"),
                (F.col("_next") != F.col("parent")).alias("_moved"),
            ),
            "jump",
        )
        moved = jumped.filter("_moved").limit(1).count()
        parents = jumped.drop("_moved")
        if not moved:
            return parents


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``a, b`` links; a component is named by its smallest id.

    Each round every id points at its smallest neighbour, chains are followed to
    their ends, and the links are drawn anew between the ends. Every component left
    with a link loses at least half of its ends per round, so rounds are few. A hub's
    neighbours meet in a partial minimum; the joins split hot ids.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    named = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent"))
        ends = follow(stored(nearest.withColumn("parent", F.least("id", "parent")), "ends"))
        if named is None:
            named = ends
        else:
            renamed = ends.select(F.col("id").alias("parent"), F.col("parent").alias("_end"))
            named = stored(
                join_skewed(named, renamed, ["parent"], "left").select("id", F.coalesce("_end", "parent").alias("parent")),
                "names",
            )
        left = ends.select(F.col("id").alias("a"), F.col("parent").alias("_a"))
        right = ends.select(F.col("id").alias("b"), F.col("parent").alias("_b"))
        moved = join_skewed(join_skewed(edges, left, ["a"], "inner"), right, ["b"], "inner")
        edges = stored(
            moved.filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "links"
        )
        if edges.limit(1).count() == 0:
            return named.select("id", F.col("parent").alias("component"))
