"""Toxic documents by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over hashed
words and word beginnings, and a document is toxic if any sentence is: the scores are
combined by noisy-or, 1 - prod(1 - p). Only documents carry labels; the gradient
of their likelihood tells which sentences to blame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import LOWER, MARKS, mix, prefix_hashes, runs, span_hashes, word_spans
from .tables import stored

BUCKETS = 1 << 18
# The labelled sample: so many ids of each label, those with the lowest hash of the id.
SAMPLE = 2500
HELD_OUT = 5
# Beginnings of words, in bytes, that are features beside the whole word.
BEGINNINGS = (4, 5, 6)
LEAST_DOCS = 5
SIGMAS = 4.5
SEED = 7
EPOCHS = 300

STOPS = np.zeros(256, dtype=bool)
STOPS[[ord(c) for c in ".!?\n"]] = True


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of texts ``first, last, data, offsets, bounds, sentence, hashed``.

    Of sentence i the bytes are ``bounds[i]`` to ``bounds[i + 1]``; sentences end after a stop or with
    their text. ``hashed`` holds the features of each word, one column per kind, and
    ``sentence`` the sentence of each word.
    """
    for first, last, data, offsets in runs(texts):
        starts, ends, _ = word_spans(data, offsets, MARKS)
        cuts = np.flatnonzero(STOPS[data]) + 1
        bounds = np.unique(np.concatenate([offsets, cuts]))
        sums = prefix_hashes(LOWER[data])
        sentence = np.searchsorted(bounds, starts, side="right") - 1
        kinds = [span_hashes(sums, starts, ends)]
        for n in BEGINNINGS:
            short = np.minimum(starts + n, ends)
            kinds.append(mix(span_hashes(sums, starts, short) + np.uint64(n)))
        hashed = (np.stack(kinds, axis=1) >> np.uint64(20)).astype(np.int64) % BUCKETS
        yield first, last, data, offsets, bounds, sentence, hashed


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample: int) -> DataFrame:
    """``id, text, y`` of at most ``sample`` ids per label, none of them held out.

    Of rows that repeat an id the one whose text has the smallest hash is taken.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .filter(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * sample ids, each with one text however many rows repeat it
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    return rows.groupBy("id", "y").agg(first["text"].alias("text")).select("id", "text", "y")


def held_out(id_: Column) -> Column:
    return F.crc32(F.encode(id_.cast("string"), "UTF-8")) % HELD_OUT == 0


def bags(sample: DataFrame) -> DataFrame:
    """``y, sizes, features``: the distinct features of each sentence, one sentence after the other."""
    schema = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("sizes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))])

    def bagged(batches):
        for batch in batches:
            ids, ys = batch.column("id"), batch.column("y")
            for first, last, _, offsets, bounds, sentence, hashed in features(batch.column("text")):
                pairs = np.unique(np.repeat(sentence, hashed.shape[1]) * BUCKETS + hashed.ravel())
                at, feature = pairs // BUCKETS, (pairs % BUCKETS).astype(np.int32)
                # a text's sentences are those that begin inside it
                left = np.searchsorted(bounds, offsets)
                cut = np.searchsorted(at, left)
                sizes, kept = [], []
                for i in range(last - first):
                    own = at[cut[i] : cut[i + 1]]
                    sizes.append(np.unique(own, return_counts=True)[1].astype(np.int32))
                    kept.append(feature[cut[i] : cut[i + 1]])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), ys.slice(first, last - first), pa.array(sizes, schema.field("sizes").type), pa.array(kept, schema.field("features").type)],
                    schema=schema,
                )

    return sample.mapInArrow(bagged, "id long, y int, sizes array<int>, features array<int>")


def telling(rows: DataFrame) -> np.ndarray:
    """The features that get a weight, at most BUCKETS of them, from the ``bags`` of a sample.

    Most words are in few documents and tell nothing: a feature must be in at least LEAST_DOCS
    documents, and its shares in toxic and clean ones must differ by SIGMAS standard errors.
    """
    filled = rows.filter(F.size("sizes") > 0)
    toxic, clean = (F.coalesce(F.sum(F.when(F.col("y") == y, 1)), F.lit(0)) for y in (1, 0))
    n1, n0 = filled.agg(toxic, clean).first()
    if not n1 or not n0:
        return np.zeros(0, dtype=np.int64)
    counts = filled.select("y", F.explode(F.array_distinct("features")).alias("feature"))
    counts = counts.groupBy("feature").agg(toxic.alias("in_toxic"), clean.alias("in_clean"))
    both = F.col("in_toxic") + F.col("in_clean")
    mean = both / F.lit(n0 + n1)
    error = F.sqrt(mean * (1 - mean) * F.lit(1 / n0 + 1 / n1)) + F.lit(1e-9)
    apart = F.abs(F.col("in_toxic") / F.lit(n1) - F.col("in_clean") / F.lit(n0)) >= SIGMAS * error
    used = counts.filter(apart & (both >= LEAST_DOCS)).select("feature").toArrow()
    return np.sort(np.asarray(used.column("feature"), dtype=np.int64))


def narrowed(rows: DataFrame, used: np.ndarray) -> DataFrame:
    """``id, y, times, sizes, features`` of ``bags``, with the given features only, numbered from 0.

    Sentences of a document that agree in these are one, which stands there ``times`` times.
    """
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    lists = pa.list_(pa.int32())
    schema = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("times", lists), ("sizes", lists), ("features", lists)])

    def narrow(batches):
        for batch in batches:
            times, sizes, features = [], [], []
            for own, ids in zip(batch.column("sizes"), batch.column("features")):
                own = np.asarray(own.values, dtype=np.int64)
                ids = number[np.asarray(ids.values)]
                sentence = np.repeat(np.arange(len(own)), own)[ids >= 0]
                ids = ids[ids >= 0]
                left = np.bincount(sentence, minlength=len(own))
                empty = int((left == 0).sum())
                alike = {b"": empty} if empty else {}
                for part in np.split(ids, np.cumsum(left[left > 0])[:-1]) if len(ids) else ():
                    key = part.tobytes()
                    alike[key] = alike.get(key, 0) + 1
                times.append(list(alike.values()))
                sizes.append([len(k) // ids.itemsize for k in alike])
                features.append(np.frombuffer(b"".join(alike), dtype=np.int32))
            arrays = [batch.column("id"), batch.column("y"), *(pa.array(x, lists) for x in (times, sizes, features))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.mapInArrow(narrow, "id long, y int, times array<int>, sizes array<int>, features array<int>")


def fit(rows: list, used: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels under noisy-or.

    ``rows`` are those of ``narrowed``. Full-batch Adam from weights of 0 and a low bias. Both
    labels weigh the same in sum. With one label only, or none, the weights stay 0 and the
    bias gives the label's score.
    """
    weights = np.zeros(BUCKETS)
    rows = [r for r in rows if len(r["sizes"])]
    y = np.array([r["y"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return weights, (20.0 if len(y) and y[0] else -20.0)
    times, sizes, feature = (np.concatenate([r[c] for r in rows]).astype(np.int64) for c in ("times", "sizes", "features"))
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    bag = np.repeat(np.arange(len(rows)), [len(r["sizes"]) for r in rows])
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    w, b = np.zeros(len(used)), -6.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(sentence, w[feature], len(sizes)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log(1 - P) of a document is the sum of log(1 - p) of its sentences
        none = np.bincount(bag, times * np.log1p(-np.minimum(p, 1 - 1e-12)), len(rows))
        doc = -np.expm1(none)
        # d log-likelihood / d sum(log(1 - p)): 1 for clean documents, -(1 - P) / P for toxic ones
        pull = np.where(y == 1, -(1 - doc) / np.maximum(doc, 1e-9), 1.0) * weight
        slope = pull[bag] * p * times
        g = np.append(np.bincount(feature, slope[sentence], len(used)) + 1e-5 * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    weights[used] = w
    return weights, float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on the bounded labelled sample.

    Features are counted and chosen in Spark. The driver gets the numbers of those chosen that each
    sentence has, equal sentences of a document once.
    """
    rows = stored(bags(labelled_sample(docs, labels, id_col, text, label, sample)), "bags")
    used = telling(rows)
    columns = narrowed(rows, used).orderBy("id").select("y", "times", "sizes", "features").toArrow()
    names = ("times", "sizes", "features")
    unpacked = [[np.asarray(x.values) for x in columns.column(c)] for c in names]
    return fit([{"y": y, **dict(zip(names, own))} for y, *own in zip(columns.column("y").to_pylist(), *unpacked)], used)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score, sentences``.

    ``sentences`` lists the offending ones, of a score of 0.5 or more, as start and end
    in code points and score. A null or empty text has no sentence and scores 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scored(batches):
        weights, bias = sent.value
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, data, offsets, bounds, sentence, hashed in features(batch.column("text")):
                # a feature counts once in a sentence
                pairs = np.unique(np.repeat(sentence, hashed.shape[1]) * BUCKETS + hashed.ravel())
                at = pairs // BUCKETS
                n = max(0, len(bounds) - 1)
                filled = np.zeros(n, dtype=bool)
                filled[sentence] = True
                z = np.bincount(at, weights[pairs % BUCKETS], n) + bias
                p = np.where(filled, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)
                owner = np.searchsorted(offsets, bounds[:n], side="right") - 1
                scores = -np.expm1(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), last - first))
                found = [[] for _ in range(last - first)]
                for s in np.flatnonzero(p >= 0.5).tolist():
                    i = int(owner[s])
                    # code points are the bytes that do not continue one
                    place = [int(((data[offsets[i] : bounds[e]] & 0xC0) != 0x80).sum()) for e in (s, s + 1)]
                    found[i].append({"start": place[0], "end": place[1], "score": round(float(p[s]), 6)})
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(np.clip(scores, 0, 1)), pa.array(found, kind)],
                    names=["doc_id", "score", "sentences"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted, sentences``.

    Labels are learnt from rows whose crc32 of the id modulo 5 is not 0, a null label
    or id from none, and from one text of each id. Scores depend on the text alone. Repeated rows score alike; an empty
    table gives no rows; without labels of both kinds all texts with words score alike;
    other columns are left out.
    """
    found = score(docs, train(docs, labels, id_col, text, label), id_col, text)
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
    )
