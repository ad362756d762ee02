"""The filter audit against one that walks through the documents."""

from itertools import permutations

import brute
import pytest

from siftline.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, bits string, same string, first string"
LABELS = "doc_id long, quality int, toxic int, n string"
LONG = "alpha beta gamma delta " * 100_000


def plain(docs, labels):
    def fails(d):
        text = d["text"] or ""
        w = brute.words(text)
        copied = any(o["doc_id"] is not None and d["doc_id"] is not None and o["doc_id"] < d["doc_id"] and (o["text"] or "") == text for o in docs)
        return {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": copied,
        }

    said = {y: {x["doc_id"] for x in labels if x[y] == 1 and x["doc_id"] is not None} for y in ("quality", "toxic")}
    found = [(d["source"] or "", d["doc_id"], fails(d)) for d in docs]
    out = {}
    for part in {p for p, _, _ in found}:
        mine = [(i, f) for p, i, f in found if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for at, own in enumerate(order, 1):
                removed = [x for x in left if x[1][own]]
                left = [x for x in left if not x[1][own]]
                shapley[own] += len(removed)
                out[part, "".join(order), at] = [
                    len(left),
                    len(removed),
                    sum(x[1][own] for x in gone),
                    sum(x[1][own] and sum(x[1].values()) == 1 for x in mine),
                    sum(x[0] in said["quality"] for x in removed),
                    sum(x[0] in said["toxic"] for x in removed),
                ]
                gone = gone + removed
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def check(spark, docs, labels):
    got = filter_audit.audit(docs, labels).collect()
    want = plain([r.asDict() for r in docs.collect()], [r.asDict() for r in labels.collect()])
    assert len(got) == len(want)
    assert {(r["part"], r["filter_order"], r["step"]): [r[m] for m in filter_audit.MEASURES] for r in got} == want


def test_edges(spark):
    rows = [
        (1, None, None),
        (2, "", ""),
        (3, "", "a"),
        (4, LONG, "a"),
        (4, LONG, "a"),
        (5, LONG, "b"),
        (None, LONG, "b"),
        (None, "short", "b"),
        (6, "short", "b"),
        (6, "short", "b"),
        (7, "SHOUT | loud", "b"),
        (8, " ".join(f"w{i}" for i in range(250)), "b"),
        (9, " ".join(f"W{i}" for i in range(250)) + " é日本𝄞" * 3, "b"),
    ]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "u") for r in rows], DOCS)
    labels = spark.createDataFrame(
        [(4, 1, 0, "x"), (4, 0, 1, "x"), (5, None, None, "x"), (None, 1, 1, "x"), (6, 1, None, "x"), (99, 1, 1, "x")], LABELS
    )
    check(spark, docs, labels)
    check(spark, docs.limit(3), labels.limit(0))


def test_empty(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0


@pytest.mark.parametrize("filters", [2, 3])
def test_fewer_filters(spark, filters):
    """The contraction is not bound to five filters."""
    counts = spark.createDataFrame([("p", f, f + 1, f % 2, 0) for f in range(1 << filters)], "part string, fails int, n long, good long, toxic long")
    rows = filter_audit.interactions(counts, "ABC"[:filters]).collect()
    assert len(rows) == len(list(permutations(range(filters)))) * filters
    total = sum(f + 1 for f in range(1 << filters))
    for r in rows:
        if r["step"] == 1:
            own = 1 << "ABC".index(r["filter_order"][0])
            assert r["removed"] == sum(f + 1 for f in range(1 << filters) if f & own)
            assert r["kept"] + r["removed"] == total and r["redundant"] == 0
        if r["step"] == filters:
            assert r["kept"] == 1
