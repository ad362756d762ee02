"""Near duplicates and decontamination against plain Python."""

import random
from collections import defaultdict

import brute
import numpy as np
import pytest

from siftline.llm import decontaminate, near_dedup
from siftline.llm.catalog import QUERIES
from siftline.llm.components import components

DOCS = "doc_id long, text string, kept string"


def rows(df):
    return [r.asDict() for r in df.collect()]


def check_components(texts, got, k):
    sets = {d: brute.shingles(t, k) for d, t in texts.items()}
    want = brute.components(sets, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates(spark):
    texts = {d["doc_id"]: d["text"] for d in brute.load("documents")}
    check_components(texts, rows(QUERIES["op2_near_duplicates"](spark, brute.SF_DIR)), 4)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return " ".join(out)


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 3])
def test_near_copies_chains_and_edges(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(1)
    texts = {1: None, 2: "", 3: " \n", 4: "One two", 5: "one  TWO", 6: "one two three", 7: "long word " * 30_000, 8: "long word " * 30_001}
    base = [f"w{i}" for i in range(200)]
    for i in range(60):
        texts[100 + i] = edited(rng, base, rng.randrange(8))
    chain = [f"c{i}" for i in range(300)]
    for i in range(40):  # each differs a little from the one before; the ends have little in common
        at = rng.randrange(300)
        chain[at : at + 6] = [f"x{i}-{j}" for j in range(6)][: max(0, 300 - at)]
        texts[300 - i] = " ".join(chain)
    data = [(d, t, "x") for d, t in texts.items()]
    docs = spark.createDataFrame([*data, data[3], (None, "one two", "x"), (None, None, "x")], DOCS)
    got = rows(near_dedup.near_duplicates(docs, k=4))
    assert len(got) == len(data) + 3
    assert sum(r["doc_id"] is None and r["component_id"] is None and r["kept"] for r in got) == 2
    check_components(texts, [r for r in got if r["doc_id"] is not None], 4)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_pairs_within_the_signature_distance_share_a_key(spark):
    rng = np.random.default_rng(0)
    one = rng.integers(0, 1 << 16, near_dedup.SYMBOLS, dtype=np.uint16)
    sigs = [one]
    for _ in range(200):
        other = one.copy()
        other[rng.choice(near_dedup.SYMBOLS, 2 * near_dedup.CHUNKS - 1, replace=False)] += 1
        sigs.append(other)
    signed = spark.createDataFrame([(bytearray(s.tobytes()), i) for i, s in enumerate(sigs)], "sig binary, node long")
    index = near_dedup.index_keys(signed)
    mine = index.filter("node = 0").select("key")
    assert index.join(mine, "key").select("node").distinct().count() == len(sigs)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(50)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["id"]: r["component"] for r in rows(components(spark.createDataFrame(links, "a long, b long")))}
    assert got == {x: root(x) for x in parent}


def tokens(text):
    return [t for t in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in brute.lower(text or "")).split(" ") if t]


def greedy(doc, item, k):
    """Greedy string tiling as published, in its plain form."""
    in_doc, in_item = set(), set()
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and a + n not in in_doc and b + n not in in_item:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < k:
            return len(in_item)
        in_doc.update(range(a, a + n))
        in_item.update(range(b, b + n))


def test_tiling_equals_its_plain_form(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abc") if i % 2 else f"t{i}x{j}" for j in range(rng.randrange(3, 25)))) for i in range(8)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            source = tokens(rng.choice(items)[1])
            a = rng.randrange(len(source))
            parts += source[a : a + rng.randrange(1, 15)]
        docs.append((i, ", ".join(parts).upper(), "x"))
    got = {r["doc_id"]: r for r in rows(decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), min_match=3))}
    blocks = {r["doc_id"]: r for r in rows(decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), min_match=3, block_bytes=200))}
    for d, text, _ in docs:
        shares = {i: greedy(tokens(text), tokens(t), 3) / len(tokens(t)) for i, t in items}
        assert got[d]["item_ids"] == sorted(i for i, s in shares.items() if s >= 0.5)
        assert got[d]["coverage"] == pytest.approx(max(shares.values()), abs=1e-6)
        assert blocks[d] == got[d] | {"tiles": blocks[d]["tiles"]}


def test_decontamination(spark):
    items = {i["item_id"]: tokens(i["text"]) for i in brute.load("benchmark")}
    docs = {d["doc_id"]: tokens(d["text"]) for d in brute.load("documents")}
    index = defaultdict(set)
    for i, t in items.items():
        for j in range(len(t) - 4):
            index[tuple(t[j : j + 5])].add(i)
    got = rows(QUERIES["op10_decontamination"](spark, brute.SF_DIR))
    assert len(got) == len(docs)
    for r in got:
        t = docs[r["doc_id"]]
        near = set().union(*(index.get(tuple(t[j : j + 5]), ()) for j in range(len(t) - 4)))
        assert r["item_ids"] == sorted(i for i in near if greedy(t, items[i], 5) >= 0.5 * len(items[i]))


def test_decontamination_edges(spark):
    passage = "the quick brown fox jumps over the lazy dog while twelve wizards make toxic brew"
    first, second = passage[:43], passage[43:]
    docs = [(1, None, "x"), (2, "", "x"), (3, f"filler {second.upper()} and then {first}!", "x"), (4, "word " * 50_000 + passage, "x"), (None, passage, "x"), (5, first[:15], "x"), (3, f"filler {second} {first}", "x")]
    items = [(7, passage), (8, None), (9, ""), (None, passage)]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    docs_df = spark.createDataFrame(docs, DOCS)
    got = rows(decontaminate.contamination(docs_df, items_df))
    assert sorted((r["doc_id"] or 0, r["n_items"]) for r in got) == [(0, 2), (1, 0), (2, 0), (3, 2), (3, 2), (4, 2), (5, 0)]
    assert decontaminate.contamination(docs_df.limit(0), items_df).count() == 0
    assert not any(r["contaminated"] for r in rows(decontaminate.contamination(docs_df, items_df.limit(0))))


def test_short_items_and_other_scripts(spark):
    items = [(1, "alpha beta gamma delta"), (2, "alpha beta"), (3, "\u4eca\u65e5\u306f\u5929\u6c17\u304c\u3068\u3066\u3082\u826f\u3044"), (4, "she said never again will we go there"), (5, "d\u00e9j\u00e0 vu \u00e0 l\u2019\u00e9cole fran\u00e7aise")]
    docs = [
        (1, "so Alpha, beta; gamma delta!", "x"),
        (2, "alpha beta gamma", "x"),
        (3, "\u524d\u7f6e\u304d\u3002\u4eca\u65e5\u306f\u5929\u6c17\u304c\u3068\u3066\u3082\u826f\u3044\u3001\u3068\u601d\u3046\u3002", "x"),
        (4, "\u201cShe said \u2018never\u2019 again\u2014will we go there?\u201d", "x"),
        (5, "voil\u00e0 : d\u00e9j\u00e0 vu \u00e0 l'\u00e9cole fran\u00e7aise", "x"),
        (6, "gamma delta alpha beta", "x"),
    ]
    got = rows(decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")))
    assert {r["doc_id"]: r["item_ids"] for r in got} == {1: [1], 2: [], 3: [3], 4: [4], 5: [5], 6: []}


def test_token_spans_by_code_point():
    import unicodedata

    import numpy as np
    from siftline.llm.arrays import token_spans

    texts = ["", "ab1 c-d", "\u00e9t\u00e9 \u2019x", "\u4e2d\u6587ab\u4e2d", "e\u0301 \U0001d49c\u3001", "", "x\u00e9", "\u00e9x"]
    encoded = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, encoded)])
    data = np.frombuffer(b"".join(encoded), np.uint8)
    starts, ends, bounds = token_spans(data, offsets)
    got = [[bytes(data[a:b]).decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(bounds, bounds[1:])]
    assert got == [[], ["ab1", "c", "d"], ["\u00e9t\u00e9", "x"], ["\u4e2d", "\u6587", "ab", "\u4e2d"], ["e\u0301", "\U0001d49c"], [], ["x\u00e9"], ["\u00e9x"]]
    assert unicodedata.category("\u0301") == "Mn"


def test_memory_of_repetitive_texts_goes_by_the_sum_of_lengths():
    import tracemalloc

    import numpy as np
    from siftline.llm.decontaminate import Block, tokens_of
    import pyarrow as pa

    block = Block([1, 2, 3], ["a " * 1000, "a a a a a b " * 150, "a"], 5, 3)
    doc = next(tokens_of(pa.array(["a " * 1_000_000])))[0]
    assert len(doc) == 1_000_000
    tracemalloc.start()
    got = {h["item_id"]: (h["covered"], h["tiles"]) for h in block.search(doc)}
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert got == {1: (1000, 1), 2: (750, 150)}


def test_words_that_a_polynomial_confuses_are_told_apart(spark):
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    got = rows(near_dedup.near_duplicates(spark.createDataFrame([(1, one, "x"), (2, other, "x"), (3, one.upper(), "x")], DOCS), k=4, percent=80))
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_hot_key_is_dealt_to_blocks(spark, monkeypatch):
    """Every pair of a hot key that is near is found once, whatever the blocks."""
    rng = random.Random(9)
    base = list(range(400))
    sets = [(i, sorted({*base[:360], *rng.sample(range(400, 400 + 40 * (1 + i % 3)), 20)})) for i in range(40)]
    frame = spark.createDataFrame(sets, "node long, shingles array<long>")
    across = frame.selectExpr("explode(array(5L, 6L)) as key", "node", "node as component")
    found = []
    for block in (1000, 7, 1):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        found.append(sorted((r["a"], r["b"]) for r in near_dedup.close_pairs(across, frame, 80).collect()))
    assert found[0] == found[1] == found[2] == sorted((a, b) for a in range(40) for b in range(a + 1, 40))
