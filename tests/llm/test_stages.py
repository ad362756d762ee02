"""The stages of the pipeline judge rows, not ids."""

import random
import zlib
from collections import Counter

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from siftline.llm import quality, stages
from siftline.llm.tables import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def make(spark, *data):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in data], DOCS).repartition(3)


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(1, prose("item", 30)), (2, prose("other", 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


# enough of them that the host is not rejected
GOOD = [(None, prose(1)), (None, prose(2)), (7, prose(3)), (8, prose(4)), *[(100 + i, prose(100 + i)) for i in range(20)]]


def test_a_rejected_row_takes_no_clean_one_with_it(spark, tables):
    bad = [(None, "too short"), (7, "too short"), (8, None), (None, None), (None, "")]
    docs = make(spark, *[(i, t, "a") for i, t in GOOD + bad])
    got = stages.quality_rules(spark, docs, tables)
    assert got.columns == docs.columns and left(got) == sorted(GOOD, key=str)
    leaks = [(None, prose(5) + " " + prose("item", 30)), (7, prose("other", 30) + " " + prose(6))]
    got = stages.decontaminate(spark, make(spark, *[(i, t, "a") for i, t in GOOD + leaks]), tables)
    assert left(got) == sorted(GOOD, key=str)


def test_null_source_and_null_text_are_told_apart(spark, tables):
    text = prose(9)
    docs = make(spark, (1, text, None), (1, None, text))
    assert left(stages.quality_rules(spark, docs, tables)) == [(1, text)]


def test_near_duplicates_by_row(spark, tables):
    near = prose(4).rsplit(" ", 1)[0] + " end"
    copies = [(9, prose(4)), (None, near), (8, prose(4)), (None, prose(1)), (5, near)]
    docs = make(spark, *[(i, t, "a") for i, t in [*GOOD, *copies, (7, prose(8))]])
    got = stages.near_duplicates(spark, docs, tables)
    # both texts of id 7 stay; of the group of 5, 8, 9 and one without an id the smallest id does
    want = [*[g for g in GOOD if g[0] != 8], (7, prose(8)), (5, near)]
    assert got.columns == docs.columns and left(got) == sorted(want, key=str)


def test_stages_of_empty_tables(spark, tables):
    empty = spark.createDataFrame([], DOCS)
    for stage in (stages.quality_rules, stages.near_duplicates, stages.decontaminate, stages.mix_sources, stages.shard_documents):
        assert stage(spark, empty, tables).count() == 0


def test_columns_of_any_name_stay(spark, tables):
    """No stage needs a name of its own among the columns of the table, and none changes what it is given."""
    names = ["_key", "_hash", "_n", "_row", "_copies", "_copy", "key", "head", "row", "size", "component_id", "kept", "gone"]
    rows = [*GOOD, (None, "too short"), (8, prose(4)), (9, prose("item", 30))]
    docs = make(spark, *[(i, t, "a") for i, t in rows])
    for n, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for stage in (stages.quality_rules, stages.near_duplicates, stages.decontaminate, stages.mix_sources):
        got = stage(spark, docs, tables)
        assert got.columns == docs.columns
        kept = got.collect()
        assert kept
        for r in kept:
            assert [r[name] for name in names] == [f"{n} {'none' if r['doc_id'] is None else r['doc_id']}" for n in range(len(names))]
    assert stages.shard_documents(spark, docs, tables).count() == len(rows)


def test_mixing_of_rows_without_an_id(spark, tables):
    """Rows that agree in id, source and size are sampled each for itself."""
    docs = make(spark, *[(None, f"w{i} x y z", "a") for i in range(300)], *[(1, "one two", "b")] * 300)
    got = stages.mix_sources(spark, docs, tables).groupBy("source", "text").count().collect()
    taken = {(r["source"], r["text"]): r["count"] for r in got}
    words = {"a": sum(4 * n for (s, _), n in taken.items() if s == "a"), "b": sum(2 * n for (s, _), n in taken.items() if s == "b")}
    # 1800 words shared 1 : 2
    assert abs(words["a"] - 600) <= 4 and abs(words["b"] - 1200) <= 2
    assert max(n for (s, _), n in taken.items() if s == "a") == 1


def test_run_against_plain_python(spark):
    """Each stage of run() against a plain version over what the stage before kept."""
    docs = brute.load("documents")
    bench = [brute.lower(x["text"]) for x in brute.load("benchmark")]
    seen, frame = [docs], spark.read.parquet(f"{brute.SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, brute.SF_DIR), "pipeline-test")
        seen.append([r.asDict() for r in frame.collect()])
    raw, ruled, single, clean, mixed, shards = seen
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    verdicts = {r["doc_id"]: r for r in quality.judge(spark.read.parquet(f"{brute.SF_DIR}/documents.parquet")).collect()}
    assert ids(ruled) == sorted(d["doc_id"] for d in raw if not brute.quality(d["text"])["base_failed"] and not verdicts[d["doc_id"]]["host_rejected"])
    group = brute.components({d["doc_id"]: brute.shingles(d["text"], 5) for d in ruled}, 80)
    assert ids(single) == sorted({group[d["doc_id"]] for d in ruled})
    gone = {d["doc_id"] for d in single} - {d["doc_id"] for d in clean}
    whole = {d["doc_id"] for d in single if any(b in brute.lower(d["text"]) for b in bench if len(brute.words(b)) >= 5)}
    assert whole <= gone and len(clean) + len(gone) == len(single)
    size, wanted = Counter(), {d["doc_id"]: d for d in clean}
    for d in clean:
        size[d["source"]] += len(brute.words(d["text"]))
    taken, copies = Counter(), Counter()
    for d in mixed:
        assert d == wanted[d["doc_id"]]
        taken[d["source"]] += len(brute.words(d["text"]))
        copies[d["doc_id"]] += 1
    for source, target in brute.targets(size).items():
        longest = max(len(brute.words(d["text"])) for d in clean if d["source"] == source)
        assert abs(taken[source] - target) <= longest
    assert max(copies.values()) <= 3
    assert ids(shards) == ids(mixed)
    for r in shards:
        text = (wanted[r["doc_id"]]["text"] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
    for shard in {r["shard"] for r in shards}:
        slots = sorted(r["slot"] for r in shards if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    ran = corpus_pipeline.run(spark, brute.SF_DIR).collect()
    assert ids([r.asDict() for r in ran]) == ids(shards)
