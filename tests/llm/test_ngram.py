"""The language model against plain Kneser-Ney over counted tuples."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from siftline.llm import ngram
from siftline.llm.arrays import LOWER, solid_hashes, span_hashes, prefix_hashes
from siftline.llm.tables import table

DOCS = "doc_id long, text string, lang string, shard string, kind string"


def tokens(text):
    return [*brute.words(brute.lower(text)), None]


def trained(texts, order):
    """A function from a text to its number of tokens, known tokens, base score and score; and the number of tokens."""
    raw, top = Counter(), Counter()
    for t in texts:
        s = ["<s>"] * (order - 1) + tokens(t)
        raw.update(s[order - 1 :])
        top.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, context = {}, {}
    for k, grams in counts.items():
        n = [sum(c == i for c in grams.values()) for i in (1, 2, 3, 4)]
        discount[k] = (0.5, 1.0, 1.5)
        if min(n) > 0:
            y = n[0] / (n[0] + 2 * n[1])
            d = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
            if all(0 < x <= i for i, x in enumerate(d, 1)):
                discount[k] = tuple(d)
        context[k] = {}
        for g, c in grams.items():
            total = context[k].setdefault(g[:-1], [0, 0.0])
            total[0] += c
            total[1] += discount[k][min(c, 3) - 1]
    v, n = len(raw), sum(raw.values())

    def p(gram):
        out = 1 / (v + 1)
        for k in range(1, order + 1):
            g = gram[-k:]
            if g[:-1] in context[k]:
                total, spared = context[k][g[:-1]]
                c = counts[k].get(g, 0)
                out = max(c - discount[k][min(c, 3) - 1], 0) * (c > 0) / total + spared / total * out
        return out

    def score(text):
        s = ["<s>"] * (order - 1) + tokens(text)
        own = s[order - 1 :]
        base = sum(math.log10((raw[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        return len(own), sum(raw[w] > 0 for w in own), base, sum(math.log10(p(tuple(s[i : i + order]))) for i in range(len(own)))

    return score, n


def check(df, order, **sizes):
    docs = [r.asDict() for r in df.select("doc_id", "text").collect()]
    seen = [d["text"] for d in docs if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 10]
    score, n = trained(seen, order)
    want = sorted((d["doc_id"] is None, d["doc_id"], *score(d["text"])) for d in docs)
    got = sorted(
        (r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"], r["held_out"], r["train_tokens"], r["perplexity"])
        for r in ngram.judge(df, order=order, **sizes).collect()
    )
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4]
        assert g[4:6] == pytest.approx(w[4:6], rel=1e-9, abs=1e-9)
        assert g[6] == (g[1] is not None and zlib.crc32(str(g[1]).encode()) % 10 == 0)
        assert g[7] == n
        assert g[8] == pytest.approx(10 ** (-w[5] / w[2]))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_plain(spark, order):
    check(table(spark, brute.SF_DIR, "documents"), order)


@pytest.mark.parametrize("order", [2, 3])
def test_many_shards(spark, order):
    """Small stretches and shards, so that hot words, and the counts of one n-gram, come from many tasks."""
    check(table(spark, brute.SF_DIR, "documents").repartition(5), order, shard_bytes=20_000, at_once=3_000)


def test_edges(spark):
    long = "of the of a " * 30_000
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long),
        (4, long),
        (5, "One ONE one Ä ä 日本 𝄞"),
        (6, "x" * 100_000),
        (7, "x" * 100_000 + " " + "x" * 99_999),
        (None, "never learnt words"),
        (11, "a b c d e f g"),
        (11, "a different text of one id"),
        (19, "never seen of the a"),
    ]
    df = spark.createDataFrame([(*r, "l", "s", "k") for r in rows], DOCS)
    check(df, 2)
    check(df, 3, shard_bytes=50_000, at_once=1_000)


def test_nothing_to_learn(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = ngram.judge(spark.createDataFrame([(held, "a b", "l", "s", "k")], DOCS)).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)
    assert ngram.judge(spark.createDataFrame([], DOCS)).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a b c", "b c a", "c c a b", "a"])], "doc_id long, text string")
    model = ngram.train(docs, order=2, shard_bytes=5)
    words = ngram.mix(np.arange(1, 2, dtype=np.uint64))
    vocabulary = np.append(np.unique(next(ngram.token_hashes(docs.toArrow().column("text").combine_chunks()))[2]), words)
    for context in vocabulary:
        pairs = np.stack([np.full(len(vocabulary), context), vocabulary], axis=1).reshape(-1)
        p, _ = ngram.probabilities(model, pairs, np.arange(0, len(pairs) + 1, 2))
        assert p[1::2].sum() == pytest.approx(1)


def test_solid_hashes():
    """Texts made so that polynomial hashes modulo 2**64 collide keep hashes of their own."""
    for size in (1024, 2048):
        bits = np.array([bin(i).count("1") % 2 for i in range(size)], dtype=np.uint8)
        data = LOWER[np.concatenate([97 + bits, 98 - bits])]
        starts, ends = np.array([0, size]), np.array([size, 2 * size])
        assert len(set(span_hashes(prefix_hashes(data), starts, ends))) == 1
        assert len(set(solid_hashes(data, starts, ends))) == 2
    words = sorted({bytes([97 + i % 3] * (i % 150) + [100 + i // 150]) for i in range(1500)})
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = solid_hashes(data, ends - [len(w) for w in words], ends)
    assert len(set(hashes.tolist())) == len(words)
    # the same wherever they stand
    turned = np.frombuffer(b"".join(words[::-1]), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words[::-1]])
    assert (solid_hashes(turned, ends - [len(w) for w in words[::-1]], ends)[::-1] == hashes).all()
