"""Repeats and toxicity: brute force, and held-out accuracy."""

import random

import brute
import numpy as np
import pytest

from siftline.llm import repeats, toxicity
from siftline.llm.catalog import QUERIES

DOCS = "doc_id long, text string, spans string"


def rows(df):
    return [r.asDict() for r in df.collect()]


def check(texts, got):
    want = brute.repeats(texts)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_repeats(spark):
    texts = {d["doc_id"]: d["text"] for d in brute.load("documents")}
    check(texts, rows(QUERIES["op6_repeats"](spark, brute.SF_DIR)))


def test_repeats_edges(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(60), text(40)
    texts = {1: None, 2: "", 3: "x" * 99, 4: "x" * 100, 5: "x" * 350, 6: "ab" * 400, 7: passage, 8: passage, 9: text(30) + passage + text(30), 10: passage[:110] + "|" + passage[5:], 11: other[:99], 12: other[:99] + "é" + other, 13: (other[:120] + "-") * 4, 14: text(20_000) + passage + other}
    for i in range(40):
        a = rng.randrange(len(passage) - 130)
        texts[20 + i] = text(rng.randrange(30)) + passage[a : a + 90 + rng.randrange(60)] + text(rng.randrange(30)) + other
    data = [(d, t, "x") for d, t in texts.items()]
    rng.shuffle(data)
    df = spark.createDataFrame(data, DOCS)
    got = rows(repeats.remove_repeats(df))
    check(texts, got)
    # split minimizers give the same
    long_ones = df.filter("octet_length(text) >= 100")
    assert repeats.hot_minimizers(long_ones, 1000, 1.0) is None and repeats.hot_minimizers(long_ones, 3, 1.0) is not None
    for hot_pieces in (1, 3, 8):
        check(texts, rows(repeats.remove_repeats(df, hot_pieces=hot_pieces, sampled=1.0)))
    whole = {r["doc_id"]: r for r in got}
    docs = spark.createDataFrame([*data, data[0], next(x for x in data if x[0] == 8), (None, passage, "x")], DOCS).repartition(5)
    more = rows(repeats.remove_repeats(docs))
    assert len(more) == len(data) + 3
    assert all(r == whole[r["doc_id"]] for r in more if r["doc_id"] is not None)
    assert [r["n_removed"] for r in more if r["doc_id"] is None] == [0]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_merged_transforms_give_the_order_of_all_suffixes():
    rng = np.random.default_rng(1)
    base = rng.integers(97, 100, 400, dtype=np.uint8).tobytes()
    texts = [base[a : a + n] for a, n in zip(rng.integers(0, 200, 50).tolist(), rng.integers(100, 180, 50).tolist())]
    doc, start = np.arange(50), np.zeros(50, dtype=np.int64)
    for shard_bytes in (300, 2000, 1 << 20):
        piece, window, n = repeats.repeated(texts, doc, start, shard_bytes)
        got = {(p, w + i) for p, w, k in zip(piece.tolist(), window.tolist(), n.tolist()) for i in range(k)}
        first, want = {}, set()
        for p, t in enumerate(texts):
            for o in range(len(t) - 99):
                if first.setdefault(t[o : o + 100], (p, o)) != (p, o):
                    want.add((p, o))
        assert got == want


def test_toxicity_on_held_out_rows(spark):
    # the smallest tables have too few labels to learn from
    got = {r["doc_id"]: r for r in rows(QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1"))}
    docs = brute.load("documents", "/root/testdata/sf0.1")
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (brute.crc(str(d["doc_id"])) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        for s in r["sentences"]:
            assert 0 <= s["start"] < s["end"] <= len(d["text"])
    labels = [x for x in brute.load("labels", "/root/testdata/sf0.1") if x["doc_id"] in got and got[x["doc_id"]]["held_out"]]
    right = sum(got[x["doc_id"]]["predicted"] == x["toxic"] for x in labels)
    assert right >= 0.98 * len(labels)


def test_toxicity_edges(spark):
    clean, bad = "One fine day. It went well\nand on", "One fine day. You moron. It went well"
    docs = [(i, bad if i % 3 == 0 else clean + f" number {i}", "x") for i in range(300)] + [(1000, None, "x"), (1001, "", "x"), (None, bad, "x"), (1002, "..!?", "x"), (1003, "é" * 10 + ". " + "word " * 50_000 + bad, "x"), (0, bad, "x")]
    labels = [(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (7, None), (1, 0), (99_999, 1)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = rows(toxicity.judge(docs, labels))
    assert len(got) == 306
    for r in got:
        if r["doc_id"] is None or r["doc_id"] == 1003 or r["doc_id"] < 300 and r["doc_id"] % 3 == 0:
            assert r["predicted"] == 1 and r["sentences"]
        else:
            assert r["predicted"] == 0
    long = next(r for r in got if r["doc_id"] == 1003)
    assert [(s["start"], s["end"]) for s in long["sentences"]] == [(250_025, 250_036)]
    assert toxicity.judge(docs.limit(0), labels).count() == 0
    assert len({r["score"] for r in rows(toxicity.judge(docs.filter("doc_id < 9"), labels.limit(0)))}) == 1


@pytest.mark.parametrize("y", [0, 1])
def test_one_label_only(spark, y):
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(30)], DOCS)
    got = rows(toxicity.judge(docs, spark.createDataFrame([(i, y) for i in range(30)], "doc_id long, toxic int")))
    assert {r["predicted"] for r in got} == {y}


def test_toxicity_sample_has_one_text_of_each_id(spark):
    texts = [(1, f"text {i}", "x") for i in range(500)] + [(2, None, "x"), (2, "", "x"), (3, "three", "x")]
    docs = spark.createDataFrame(texts, DOCS).repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] * 3, "doc_id long, toxic int")
    got = rows(toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 100))
    assert sorted(r["id"] for r in got) == [i for i in (1, 2, 3) if brute.crc(str(i)) % 5]
    again = rows(toxicity.labelled_sample(docs.repartition(7), labels, "doc_id", "text", "toxic", 100))
    assert sorted(got, key=lambda r: r["id"]) == sorted(again, key=lambda r: r["id"])


def test_toxicity_features_are_chosen_as_by_hand(spark):
    """Features against a plain count, and sentences that agree in the chosen ones are sent once."""
    rng = random.Random(5)
    plain = lambda: " ".join(rng.choice(["fine", "day", "walk", "tree", "river", "stone"]) for _ in range(5)) + ". "
    data = [(i, plain() * 3 + ("you moron. " if i % 2 else "") + plain(), i % 2) for i in range(80)]
    sample = spark.createDataFrame(data, "id long, text string, y int")
    found = toxicity.bags(sample).cache()
    bagged = rows(found)
    in_docs = {}
    for r in bagged:
        for f in set(r["features"]):
            in_docs.setdefault(f, [0, 0])[r["y"]] += 1
    want = []
    for f, (clean, toxic) in in_docs.items():
        mean = (clean + toxic) / 80
        error = (mean * (1 - mean) * (1 / 40 + 1 / 40)) ** 0.5 + 1e-9
        if abs(toxic / 40 - clean / 40) >= toxicity.SIGMAS * error and clean + toxic >= toxicity.LEAST_DOCS:
            want.append(f)
    used = toxicity.telling(found)
    assert want and used.tolist() == sorted(want)
    sent = {r["id"]: r for r in rows(toxicity.narrowed(found, used))}
    for r in bagged:
        own = sent[r["id"]]
        assert sum(own["times"]) == len(r["sizes"]) and len(own["sizes"]) == len(own["times"]) <= 2
        assert sum(own["sizes"]) == len(own["features"])
        counted = sum(t * n for t, n in zip(own["times"], own["sizes"]))
        assert counted == sum(f in set(want) for f in r["features"])
    # a text a hundred times as long sends as much
    long = toxicity.bags(spark.createDataFrame([(i, t * 100, y) for i, t, y in data], "id long, text string, y int"))
    assert sum(len(r["sizes"]) for r in rows(toxicity.narrowed(long, used))) == sum(len(r["sizes"]) for r in sent.values())
    assert toxicity.telling(found.filter("y = 0")).tolist() == []
