"""Hard negatives: rows of another label that score just under an anchor's positives.

Every vector is turned by one random rotation and coded by signs: a first code of one
bit per dimension with its alignment, the mean size of what it stands for, then further
codes of what the ones before leave over. An anchor is held against a code by popcounts
over the bit planes of its rounded, rotated components. What the codes leave out of a
score is bounded by Cauchy-Schwarz, so that each estimate comes with an interval that
holds the score for certain. Rows whose interval cannot reach the result are dropped;
the rest are scored in integers.

Anchors meet all rows in cells of a block of rows and a group of anchors, both of bounded
size, whatever the number of either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .tables import stored

SEED = 11
CODES = 6
# Codes that are held against all pairs of a cell; the others only against what is left.
DENSE = 3
PLANES = 6
POSITIVES = 5
NEGATIVES = 5
ROW_BLOCK = 1 << 14
ANCHOR_BLOCK = 1 << 13
PAIRS_AT_ONCE = 1 << 18

_INDEX = "row long, vec_id long, label long, ints binary, codes binary, shape binary"
_FOUND = "row long, at int, other long, other_row long, score long"
_NOTHING = pa.schema([("row", pa.int64()), ("at", pa.int32()), ("other", pa.int64()), ("other_row", pa.int64()), ("score", pa.int64())])
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@lru_cache(maxsize=2)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def padded(size: int) -> int:
    """Dimensions are filled up with zeros to whole words of 64 bits."""
    return max(1, -(-size // 64)) * 64


def quantized(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(256 x) of each component as 32-bit integers.

    Beyond 28 bits, fewer from 128 dimensions on, they saturate, so that a score fits 64 bits.
    """
    flat = np.floor(256.0 * np.asarray(vectors.flatten(), dtype=np.float64))
    most = 2 ** ((62 - int(np.ceil(np.log2(dim)))) // 2)
    sizes = np.asarray(vectors.value_lengths(), dtype=np.int64)
    out = np.zeros((len(sizes), dim), dtype=np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.clip(flat, -most, most)
    return out


def encode(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``codes, shape`` of each vector.

    ``codes`` holds CODES bit strings. ``shape`` holds their alignments, the length of what
    is left over after each of them, and the vector's own length.
    """
    rest = ints @ rotation(ints.shape[1])
    codes, aligned, left = [], [], []
    for _ in range(CODES):
        signs = rest >= 0
        scale = np.abs(rest).mean(axis=1)
        rest -= np.where(signs, scale[:, None], -scale[:, None])
        codes.append(np.packbits(signs, axis=1, bitorder="little").view(np.uint64))
        aligned.append(scale)
        left.append(np.linalg.norm(rest, axis=1))
    length = np.linalg.norm(ints.astype(np.float64), axis=1)
    return np.stack(codes, axis=1), np.stack([*aligned, *left, length], axis=1)


def index(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> tuple[DataFrame, int]:
    """The coded rows, written to the shared folder, and their padded dimension.

    Rows with a null label, a null vector or a component that is null or not finite are left
    out. ``row`` tells apart rows that repeat an id. A shorter vector counts as filled up with zeros.
    """
    x = F.col(vector).cast("array<double>")
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    said = F.col(label) if isinstance(label, str) else label
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), said.cast("long").alias("label"), x.alias("x")).filter(
        F.col("label").isNotNull() & F.col("x").isNotNull() & ~broken
    )
    dim = padded(vectors.select(F.max(F.size(F.col(vector)))).first()[0] or 0)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = quantized(batch.column("x"), dim)
            codes, shape = encode(ints)
            packed = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (ints, codes, shape)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), batch.column("label"), *packed],
                names=["row", "vec_id", "label", "ints", "codes", "shape"],
            )

    return stored(usable.withColumn("row", F.monotonically_increasing_id()).mapInArrow(coded, _INDEX), "coded"), dim


class Block:
    """The rows of a cell as arrays."""

    def __init__(self, table: pa.Table, dim: int):
        self.row = table.column("row").to_numpy()
        self.label = table.column("label").to_numpy()
        # a row without an id comes after all others of its score
        self.nameless = np.asarray(table.column("vec_id").is_null())
        self.id = table.column("vec_id").fill_null(0).to_numpy()
        self.ints = _joined(table, "ints", np.int32, dim)
        self.codes = _joined(table, "codes", np.uint64, CODES * dim // 64).reshape(-1, CODES, dim // 64)
        shape = _joined(table, "shape", np.float64, 2 * CODES + 1)
        self.aligned, self.left, self.length = shape[:, :CODES], shape[:, CODES : 2 * CODES], shape[:, -1]
        self.set_bits = np.bitwise_count(self.codes).sum(axis=-1, dtype=np.int32)


class Anchors:
    """The anchors of a cell: rotated, rounded to PLANES bits, and cut into bit planes."""

    def __init__(self, table: pa.Table, dim: int):
        self.row = table.column("row").to_numpy()
        self.label = table.column("label").to_numpy()
        self.ints = _joined(table, "ints", np.int32, dim)
        turned = self.ints @ rotation(dim)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2**PLANES - 1), 1e-300)
        level = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
        self.error = np.linalg.norm(turned - self.low[:, None] - self.step[:, None] * level, axis=1)
        self.sum = level.sum(axis=1)
        self.length = np.linalg.norm(self.ints.astype(np.float64), axis=1)
        self.planes = np.stack(
            [np.packbits((level >> j) & 1 == 1, axis=1, bitorder="little").view(np.uint64) for j in range(PLANES)]
        )


def _joined(table: pa.Table, column: str, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=kind).reshape(-1, width)


def part_of_score(block: Block, anchors: Anchors, r, a, k: int) -> np.ndarray:
    """What code ``k`` adds to the estimate of the pairs (row ``r``, anchor ``a``), by popcounts."""
    codes, dim = block.codes[r, k], block.ints.shape[1]
    overlap = 0
    for j in range(PLANES):
        overlap = overlap + (np.bitwise_count(codes & anchors.planes[j][a]).sum(axis=-1, dtype=np.int32) << j)
    signed = anchors.step[a] * (2 * overlap - anchors.sum[a]) + anchors.low[a] * (2 * block.set_bits[r, k] - dim)
    return block.aligned[r, k] * signed


def margin(block: Block, anchors: Anchors, r, a, k: int) -> np.ndarray:
    """Cauchy-Schwarz: how far the score may lie from the estimate by codes 0 to ``k``."""
    left = block.left[r, k]
    most = left * anchors.length[a] + (block.length[r] + left) * anchors.error[a]
    return most * (1 + 1e-9) + 1e-9 * block.length[r] * anchors.length[a] + 1e-6


def kth_highest(group: np.ndarray, values: np.ndarray, k: int, groups: int) -> np.ndarray:
    """Per group the k-th highest value, or minus infinity where there are fewer."""
    order = np.lexsort((-values, group))
    first = np.searchsorted(group[order], np.arange(groups))
    at = first + k - 1
    out = np.full(groups, -np.inf)
    inside = at < np.append(first[1:], len(order))
    out[inside] = values[order][at[inside]]
    return out


def best(group: np.ndarray, score: np.ndarray, r: np.ndarray, block: Block, k: int) -> np.ndarray:
    """Places of the first ``k`` pairs of each group: highest score, then smallest id."""
    order = np.lexsort((block.row[r], block.id[r], block.nameless[r], -score, group))
    sorted_group = group[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group)
    return order[rank < k]


def scored(block: Block, anchors: Anchors, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    out = np.empty(len(r), dtype=np.int64)
    run = max(1, PAIRS_AT_ONCE * 8 // block.ints.shape[1])
    for first in range(0, len(r), run):
        part = slice(first, first + run)
        out[part] = np.einsum("ij,ij->i", block.ints[r[part]], anchors.ints[a[part]], dtype=np.int64)
    return out


def surviving(block: Block, anchors: Anchors, rows: np.ndarray, mine: np.ndarray, allowed, bands: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, anchor, score`` of all pairs that may be among the first ``k`` of a band.

    ``bands`` holds the bounds ``anchor, band, (low, high)``; ``allowed`` tells which pairs
    count at all. A pair is dropped if its interval misses every band, or lies below the
    k-th highest lower bound of pairs that are in the band for certain.
    """
    kept_r, kept_a = [], []
    run = max(1, PAIRS_AT_ONCE // max(1, len(rows)))
    for first in range(0, len(mine), run):
        some = mine[first : first + run]
        guess = 0.0
        for c in range(DENSE):
            guess = guess + part_of_score(block, anchors, rows[None, :], some[:, None], c)
        off = margin(block, anchors, rows[None, :], some[:, None], DENSE - 1)
        floor, ceiling = bands[some, :, 0].min(axis=1), bands[some, :, 1].max(axis=1)
        near = (guess + off >= floor[:, None]) & (guess - off <= ceiling[:, None]) & allowed(rows[None, :], some[:, None])
        at, r = np.nonzero(near)
        a, guess = some[at], guess[near]
        r = rows[r]
        for c in range(DENSE - 1, CODES):
            if c >= DENSE:
                guess = guess + part_of_score(block, anchors, r, a, c)
            off = margin(block, anchors, r, a, c)
            low, high = guess - off, guess + off
            wanted = np.zeros(len(r), dtype=bool)
            for b in range(bands.shape[1]):
                lowest, highest = bands[a, b, 0], bands[a, b, 1]
                sure = (low >= lowest) & (high <= highest)
                bar = kth_highest(a[sure], low[sure], k, len(anchors.row))
                wanted |= (high >= np.maximum(lowest, bar[a])) & (low <= highest)
            r, a, guess = r[wanted], a[wanted], guess[wanted]
        kept_r.append(r)
        kept_a.append(a)
    r, a = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (kept_r, kept_a))
    return r, a, scored(block, anchors, r, a)


def _rows(anchors: Anchors, block: Block, a, at, r, score) -> pa.Table:
    other = pa.array(block.id[r], mask=block.nameless[r])
    return pa.table([anchors.row[a], at.astype(np.int32), other, block.row[r], score], schema=_NOTHING)


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, match) -> DataFrame:
    """Every anchor against every row, cell by cell."""
    place = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    left = rows.withColumn("_block", place).withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # the anchors are rows of the same table: renamed, so that the two sides of the cogroup stay apart
    own = anchors.select(*[F.col(c).alias(c) for c in anchors.columns if c not in ("codes", "shape")])
    right = own.withColumn("_group", group).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("_block", "_group").cogroup(right.groupBy("_block", "_group")).applyInArrow(match, _FOUND)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each anchor over all cells, of which each gives at most ``k``."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(rows: DataFrame, anchors: DataFrame, dim: int, blocks: int, groups: int, k: int) -> DataFrame:
    """``row, rank, other, score``: the first ``k`` other rows of each anchor's own label."""

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _NOTHING.empty_table()
        block, own = Block(left, dim), Anchors(right, dim)
        everywhere = np.tile(np.array([[[-np.inf, np.inf]]]), (len(own.row), 1, 1))
        parts = []
        for label in np.unique(own.label):
            same, mine = np.flatnonzero(block.label == label), np.flatnonzero(own.label == label)
            r, a, score = surviving(block, own, same, mine, lambda r, a: block.row[r] != own.row[a], everywhere, k)
            first = best(a, score, r, block, k)
            parts.append(_rows(own, block, a[first], np.zeros(len(first)), r[first], score[first]))
        return pa.concat_tables([_NOTHING.empty_table(), *parts])

    return _first(_meet(rows, anchors, blocks, groups, match), ["row"], k).select("row", "rank", "other", "score")


def negatives(rows: DataFrame, anchors: DataFrame, dim: int, blocks: int, groups: int, k: int, percent: int) -> DataFrame:
    """``row, at, rank, other, score``: per anchor and positive the first ``k`` rows of another label.

    ``anchors`` carry ``targets``, the scores of their positives; ``at`` is the place in it. Scores lie
    between ``percent`` % of the positive's and all of it.
    """

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _NOTHING.empty_table()
        block, own = Block(left, dim), Anchors(right, dim)
        given = right.column("targets").to_pylist()
        most = max(map(len, given), default=0)
        # a missing or negative positive leaves an empty band
        bands = np.tile(np.array([np.inf, -np.inf]), (len(given), max(1, most), 1))
        exact = np.full((len(given), max(1, most)), -1, dtype=np.int64)
        for i, scores in enumerate(given):
            for j, p in enumerate(scores):
                if p >= 0:
                    bands[i, j], exact[i, j] = (p * percent / 100 - 1, p + 1), p
        everyone, mine = np.arange(len(block.row)), np.flatnonzero((exact >= 0).any(axis=1))
        r, a, score = surviving(block, own, everyone, mine, lambda r, a: block.label[r] != own.label[a], bands, k)
        parts = []
        for j in range(most):
            top = exact[a, j]
            # percent / 100 of the positive, rounded up, without a product beyond 64 bits
            least = top // 100 * percent - (-(top % 100) * percent // 100)
            inside = np.flatnonzero((top >= 0) & (score <= top) & (score >= least))
            first = inside[best(a[inside], score[inside], r[inside], block, k)]
            parts.append(_rows(own, block, a[first], np.full(len(first), j), r[first], score[first]))
        return pa.concat_tables([_NOTHING.empty_table(), *parts])

    return _first(_meet(rows, anchors, blocks, groups, match), ["row", "at"], k).select("row", "at", "rank", "other", "score")


def mine(rows: DataFrame, dim: int, is_anchor: Column, per_anchor: int = POSITIVES, per_positive: int = NEGATIVES, percent: int = 80) -> DataFrame:
    """Hard negatives from the table of :func:`index`; the columns are RESULT.

    A score is the inner product of the integer components. An anchor's positives are its first
    ``per_anchor`` other rows of the same label; for each of them the first ``per_positive`` rows
    of another label that reach ``percent`` % of its score and do not exceed it. Higher scores come
    first, ties by smaller id, null ids last. Rows that repeat an id count each: they may be each
    other's positives, and each such anchor has results of its own.
    """
    spark = rows.sparkSession
    anchors = rows.filter(is_anchor)
    n, m = rows.count(), anchors.count()
    if not m:
        return spark.createDataFrame([], RESULT)
    blocks, groups = -(-n // ROW_BLOCK), -(-m // ANCHOR_BLOCK)
    found = stored(positives(rows, anchors, dim, blocks, groups, per_anchor), "positives")
    listed = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_all"))
    aimed = anchors.join(listed, "row").select(*anchors.columns, F.col("_all.score").alias("targets"))
    under = negatives(rows, aimed, dim, blocks, groups, per_positive, percent)
    names = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    told = found.select("row", (F.col("rank") - 1).alias("at"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        under.withColumnRenamed("other", "negative_id")
        .withColumnRenamed("score", "negative_score")
        .join(told, ["row", "at"])
        .join(names, "row")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """Anchors are rows whose id is divisible by 100; every seventh id takes the next of ten labels.

    An empty table or one without anchors gives no rows; other columns are left out.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows, dim = index(vectors, label=moved)
    return mine(rows, dim, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_sum([p[1] * p[2] for p in list_zip(a.v, o.v)])::BIGINT AS score
  FROM e a JOIN e o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
