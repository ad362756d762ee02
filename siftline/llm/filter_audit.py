"""How filters interact: what each removes alone, together, and in every order.

The documents of a part are counted by which filters they fail, which gives a table
of 2 x 2 x .. x 2 counts with one axis per filter. Every figure of the audit is a
contraction of that table: along each axis it takes the documents that pass, those
that fail, or all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import join_skewed
from .tables import GAP, stored, text_of

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
# So many parts are contracted at a time.
PARTS_AT_ONCE = 64

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> list[Column]:
    """Whether a text fails A and B (a struct of ``short`` and ``repetitive``), C and D."""
    words = F.array_remove(F.split(text, GAP), "")
    # the words are listed once for both counts
    listed = F.transform(
        F.array(words),
        lambda w: F.struct(
            (F.size(w) < 200).alias("short"),
            (F.lit(2).cast("long") * F.size(F.array_distinct(w)) < F.size(w)).alias("repetitive"),
        ),
    )[0]
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [listed, F.lit(100).cast("long") * capitals > F.lit(2) * F.length(text), text.rlike(r"[#$%&*|]")]


def flag(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: ``part, doc_id, fails``; bit 0 of ``fails`` is filter A, bit 4 is E.

    A null text counts as empty, a null source as the empty one. E fails a row whose text
    is that of a smaller id anywhere in the table; a row without an id neither fails it
    nor makes others fail.
    """
    t = text_of(text)
    listed, shouting, marked = failures(t)
    found = [F.col("listed.short"), F.col("listed.repetitive"), F.col("shouting"), F.col("marked")]
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(found)), F.lit(0))
    rows = stored(
        docs.select(
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)).alias("same"),
            listed.alias("listed"),
            shouting.alias("shouting"),
            marked.alias("marked"),
        ).select("part", "doc_id", "same", bits.alias("bits")),
        "audit",
    )
    # Copies shrink to one row per map task here, and below they meet on (text, id), not on the text.
    firsts = rows.filter("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("doc_id"))
    met = join_skewed(rows, firsts.withColumn("first", F.lit(True)), ["same", "doc_id"], "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return met.select("part", "doc_id", (F.col("bits") + copy).alias("fails"))


def tally(flagged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, fails, n, good, toxic``: at most 32 rows per part.

    A document is good or toxic if any label row of its id says so.
    """
    said = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    told = join_skewed(flagged, said.filter("doc_id is not null"), ["doc_id"], "left")
    return told.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def steps(filters: int) -> tuple[list[tuple[int, ...]], dict[str, list[np.ndarray]]]:
    """All orders of the filters, and per figure and axis the choice made at each step of each order.

    The choices of an axis are an array of one row per step, with a 1 for the side, pass or
    fail, that is taken; both for all.
    """
    orders = list(permutations(range(filters)))
    chosen = {name: np.empty((filters, len(orders) * filters, 2), dtype=np.int64) for name in ("kept", "removed", "failing", "unique")}
    for o, order in enumerate(orders):
        for at, own in enumerate(order):
            row = o * filters + at
            for axis in range(filters):
                earlier = order.index(axis) < at
                before = PASS if earlier else ALL
                chosen["kept"][axis, row] = PASS if axis == own else before
                chosen["removed"][axis, row] = FAIL if axis == own else before
                chosen["failing"][axis, row] = FAIL if axis == own else ALL
                chosen["unique"][axis, row] = FAIL if axis == own else PASS
    return orders, {name: list(axes) for name, axes in chosen.items()}


def contract(tensor: np.ndarray, axes: Sequence[np.ndarray]) -> np.ndarray:
    """``parts x steps x measures`` from ``parts x 2 x .. x 2 x measures`` and the choices of each axis."""
    names = "abcdefgh"[: len(axes)]
    terms = ",".join([f"p{names}m", *[f"s{a}" for a in names]])
    return np.einsum(f"{terms}->psm", tensor, *axes, optimize="greedy")


def interactions(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, with :data:`MEASURES`.

    ``counts`` is that of :func:`tally`. A part's counts are one row of bounded size, so
    parts are spread over tasks whatever their number.
    """
    k = len(filters)
    orders, choices = steps(k)
    names = ["".join(filters[f] for f in order) for order in orders]
    own = np.array(orders).reshape(-1)
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))

    def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_column = pa.array(np.repeat(np.array(names, dtype=object), k), pa.string())
        for batch in batches:
            for first in range(0, batch.num_rows, PARTS_AT_ONCE):
                part = batch.slice(first, PARTS_AT_ONCE)
                flat = np.zeros((part.num_rows, 1 << k, 3), dtype=np.int64)
                for i, found in enumerate(part.column("cells").to_pylist()):
                    for cell in found:
                        flat[i, cell["fails"]] = cell["n"], cell["good"], cell["toxic"]
                # bit 0 is the last axis of the reshaped table; turn the axes round to filter order
                tensor = flat.reshape(part.num_rows, *(2,) * k, 3).transpose(0, *range(k, 0, -1), k + 1)
                removed = contract(tensor, choices["removed"])
                kept, failing, unique = (contract(tensor[..., :1], choices[c])[..., 0] for c in ("kept", "failing", "unique"))
                total = np.zeros((part.num_rows, k), dtype=np.int64)
                np.add.at(total, (slice(None), own), removed[..., 0])
                columns = (
                    kept, removed[..., 0], failing - removed[..., 0], unique, removed[..., 1], removed[..., 2], total[:, own],
                )
                for i, name in enumerate(part.column("part").to_pylist()):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(own), pa.string()),
                            order_column,
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))),
                            *[pa.array(c[i]) for c in columns],
                        ],
                        names=["part", "filter_order", "step", *MEASURES],
                    )

    return cells.mapInArrow(contracted, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The five filters over whole texts, in each of their 120 orders.

    A: under 200 words; B: under half of them distinct; C: more than 2 % capitals; D: one
    of ``#$%&*|``; E: the text of a smaller id. Empty texts fail A alone; repeated rows count
    each, and do not fail E by one another, as their ids are equal; an empty table has no
    parts and gives no rows; other columns are left out.
    """
    return interactions(tally(flag(docs, id_col, text, source), labels, id_col))


ORACLE = r"""
WITH d AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT t, min(doc_id) AS lowest FROM d GROUP BY t
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (len(w) < 200)::INT AS a,
         (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b,
         (100 * length(regexp_replace(d.t, '[^A-Z]+', '', 'g')) > 2 * length(d.t))::INT AS c,
         regexp_matches(d.t, '[#$%&*|]')::INT AS d,
         coalesce(s.lowest < d.doc_id, false)::INT AS e
  FROM d JOIN s ON d.t = s.t LEFT JOIN l ON d.doc_id = l.doc_id
), g AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL
), bit AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS own
), orders AS (
  SELECT v.name || w.name || x.name || y.name || z.name AS filter_order, [v.own, w.own, x.own, y.own, z.own] AS owns
  FROM bit v, bit w, bit x, bit y, bit z
  WHERE v.own + w.own + x.own + y.own + z.own = 31 AND v.own | w.own | x.own | y.own | z.own = 31
), step AS (
  SELECT filter_order, k::INT AS step, owns[k] AS own, coalesce(list_sum(owns[1:k - 1]), 0)::INT AS earlier
  FROM orders, range(1, 6) r(k)
), m AS (
  SELECT g.part, filter_order, step, own,
         sum(CASE WHEN fails & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & earlier > 0 AND fails & own > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & earlier = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM g, step GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM m
"""
