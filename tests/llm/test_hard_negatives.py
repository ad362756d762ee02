"""Hard negatives against a plain search, and the intervals against the scores they must hold."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from siftline.llm import hard_negatives as hn

VECTORS = "vec_id long, embedding array<float>, label int, row string, rank string, codes string, at string"


def plain(rows):
    """Rows are ``(vec_id, embedding, label)``."""
    kept = []
    for i, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, [math.floor(256 * float(np.float32(c))) for c in x], label))
    last = float("inf")
    out = []
    for a, anchor in enumerate(kept):
        if anchor[0] is None or anchor[0] % 100:
            continue
        scored = [
            (sum(p * q for p, q in zip(anchor[1], o[1])), last if o[0] is None else o[0], o[2] == anchor[2])
            for b, o in enumerate(kept)
            if b != a
        ]
        order = sorted(scored, key=lambda s: (-s[0], s[1]))
        for p in [s for s in order if s[2]][:5]:
            inside = [s for s in order if not s[2] and 80 * p[0] <= 100 * s[0] <= 100 * p[0]][:5]
            out += [(anchor[0], p[1], k, n[1], p[0], n[0]) for k, n in enumerate(inside, 1)]
    return sorted((tuple(None if v == last else v for v in r) for r in out), key=repr)


def found(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "k", "c", "a") for r in rows], VECTORS)


def near(n, dim, seed, labels=3):
    """Vectors around a few centres, so that scores lie close together."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    x = centres[rng.integers(4, size=n)] + 0.5 * rng.standard_normal((n, dim))
    return [(i, [float(c) for c in x[i]], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dim, n", [(3, 350), (64, 620), (70, 301)])
def test_plain(spark, dim, n):
    rows = near(n, dim, dim)
    assert found(hn.hard_negatives(table(spark, rows))) == plain(rows)


def test_many_cells(spark, monkeypatch):
    """Blocks of rows and groups of anchors far smaller than the table give the same."""
    rows = near(900, 16, 5)
    monkeypatch.setattr(hn, "ROW_BLOCK", 100)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 2)
    assert found(hn.hard_negatives(table(spark, rows))) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.5], 1),
        (100, [1.0, 0.5], 1),
        (200, [0.0, 0.0], 1),
        (300, [-1.0, 0.25], 2),
        (700, [1.0, 1.0], 9),
        (None, [1.0, 0.5], 1),
        (None, [0.9, 0.5], 2),
        (1, [0.9, 0.5], 2),
        (2, [0.9, 0.5], 2),
        (2, [0.9, 0.5], 2),
        (3, [0.85, 0.5], 0),
        (4, [0.8], 0),
        (5, [], 0),
        (6, None, 1),
        (8, [1.0, None], 1),
        (9, [1.0, nan], 1),
        (10, [inf, 1.0], 1),
        (11, [1.0, 0.5], None),
        (12, [0.95, 0.5, 0.0], 1),
    ]
    assert found(hn.hard_negatives(table(spark, rows))) == plain(rows)


def test_empty(spark):
    assert hn.hard_negatives(table(spark, [])).count() == 0
    assert hn.hard_negatives(table(spark, [(1, [1.0], 1)])).count() == 0
    assert hn.hard_negatives(table(spark, [(100, [1.0], 1)])).count() == 0


def test_huge_components(spark):
    """Components that saturate still give an order, and scores of 64 bits."""
    rows = [(100, [3e38] * 64, 1), (1, [3e38] * 64, 1), (2, [3e38] * 64, 2), (3, [-3e38] * 64, 2)]
    (row,) = hn.hard_negatives(table(spark, rows)).collect()
    assert (row["negative_id"], row["positive_id"], row["positive_score"]) == (2, 1, row["negative_score"])
    assert 0 < row["positive_score"] < 2**63


@pytest.mark.parametrize("dim", [5, 64, 200])
def test_intervals_hold_the_scores(dim):
    """The estimate by the first codes, give or take its margin, always holds the score; later codes narrow it."""
    rng = random.Random(dim)
    kinds = [lambda: rng.gauss(0, 1), lambda: rng.choice([0.0, 5.0]), lambda: rng.gauss(0, 1) * 10 ** rng.randint(-3, 3)]
    vectors = [[kind() for _ in range(dim)] for kind in kinds for _ in range(30)] + [[0.0] * dim]
    size = hn.padded(dim)
    ints = hn.quantized(pa.array(vectors, pa.list_(pa.float64())), size)
    codes, shape = hn.encode(ints)
    n = len(vectors)
    own = pa.table(
        {
            "row": pa.array(range(n), pa.int64()),
            "vec_id": pa.array(range(n), pa.int64()),
            "label": pa.array([0] * n, pa.int64()),
            **{name: pa.array([r.tobytes() for r in a], pa.binary()) for name, a in (("ints", ints), ("codes", codes), ("shape", shape))},
        }
    )
    block, anchors = hn.Block(own, size), hn.Anchors(own, size)
    score = ints.astype(np.int64) @ ints.astype(np.int64).T
    rows, mine = np.arange(n)[None, :], np.arange(n)[:, None]
    guess, widths = 0.0, []
    for k in range(hn.CODES):
        guess = guess + hn.part_of_score(block, anchors, rows, mine, k)
        off = hn.margin(block, anchors, rows, mine, k)
        assert (np.abs(guess - score) <= off).all()
        widths.append(off.mean())
    assert widths == sorted(widths, reverse=True)
