"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A text is the set of its shingles of ``k`` words. Its signature has SYMBOLS
minimum hashes of 16 bits. Two signatures differ in some of these symbols, and the
chance of it falls with the similarity of the sets. Signatures are cut into CHUNKS
chunks. If two signatures differ in at most 2 * CHUNKS - 1 symbols, then by the
pigeonhole principle some chunk differs in at most one. The errors allowed in a chunk
are enumerated by leaving out each symbol in turn, so such a pair shares a key for
certain. Sets of similarity 0.8 that share no key have a chance below 1e-6.

All candidates are confirmed on full sets. They are tried in two passes, as components
are what is asked for. First each document is held against one representative: the most
connected document of the keys they share, such as the original of many edited copies.
Then come all pairs with a common key that are still in different components, apart from
documents of which too many shingles occur nowhere else: if more than a fifth of a set
is its own, nothing can be similar to it by 0.8. That test is exact. The pairs must
also be near by a long signature of BITS one-bit hashes, at a distance that sets of the
wanted similarity exceed with a chance of about 1e-9, and each is emitted at one of its
keys only. So neither a hot key nor a group of copies is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import join_skewed
from .arrays import gram_hashes, mix, runs, word_hashes, word_spans
from .components import components
from .tables import stored

SYMBOLS = 48
CHUNKS = 10
# Chunks of 5 symbols, then of 4.
BOUNDS = np.linspace(0, SYMBOLS, CHUNKS + 1).round().astype(int)
_numbers = mix(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64))
# The long signature, for the documents that are left for the second pass.
BITS = 2048
SIGMAS = 6
# So many documents of a key are held against the others by one task.
BLOCK = 2000
WORDS = [f"w{i}" for i in range(BITS // 64)]
FACTORS, SHIFTS = _numbers[:SYMBOLS] | np.uint64(1), _numbers[SYMBOLS:]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[list[np.ndarray]]:
    """The distinct shingle hashes of each text, run by run.

    With fewer than ``k`` words the whole sequence is the one shingle; without words there is none.
    """
    for first, last, data, offsets in runs(texts):
        starts, ends, bounds = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        sets = []
        for i in range(last - first):
            own = words[bounds[i] : bounds[i + 1]]
            sets.append(np.unique(gram_hashes(own, min(k, len(own)))) if len(own) else own)
        yield sets


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, c1, c2, sig`` of ``doc_id, text`` rows.

    Equal sets have equal ``n_shingles, c1, c2``; ``sig`` is null for an empty set.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("sig", pa.binary())])

    def signed(batches):
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for sets in shingle_sets(batch.column("text"), k):
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(sizes)
                every = np.concatenate(sets) if len(full) else np.zeros(0, np.uint64)
                heads = (np.cumsum(sizes) - sizes)[full]
                c = np.zeros((2, len(sets)), dtype=np.uint64)
                sig = np.zeros((len(sets), SYMBOLS), dtype=np.uint16)
                if len(full):
                    c[0, full] = np.add.reduceat(mix(every ^ SHIFTS[0]), heads)
                    c[1, full] = np.add.reduceat(mix(every ^ SHIFTS[1]), heads)
                    for j in range(SYMBOLS):
                        low = np.minimum.reduceat(every * FACTORS[j] + SHIFTS[j], heads)
                        sig[full, j] = mix(low).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(sets)),
                        pa.array(sizes),
                        pa.array(c[0].view(np.int64)),
                        pa.array(c[1].view(np.int64)),
                        pa.array([s.tobytes() if n else None for s, n in zip(sig, sizes)], pa.binary()),
                    ],
                    schema=schema,
                )
                at += len(sets)

    return docs.mapInArrow(signed, "doc_id long, n_shingles long, c1 long, c2 long, sig binary")


def index_keys(signed: DataFrame) -> DataFrame:
    """``key, node``: for each chunk of each signature one key per symbol left out."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def keyed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS).astype(np.uint64)
            keys = []
            for chunk, (a, b) in enumerate(zip(BOUNDS[:-1], BOUNDS[1:])):
                for out in range(a, b):
                    key = np.full(len(sig), chunk * SYMBOLS + out + 1, dtype=np.uint64)
                    for j in range(a, b):
                        if j != out:
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, j])
                    keys.append(key.view(np.int64))
            nodes = np.tile(np.asarray(batch.column("node")), SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(nodes)], schema=schema)

    return signed.select("sig", "node").mapInArrow(keyed, "key long, node long")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, shingles`` of ``doc_id, text`` rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def listed(batches):
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for sets in shingle_sets(batch.column("text"), k):
                sizes = np.array([0, *(len(s) for s in sets)])
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(sets)), lists], schema=schema)
                at += len(sets)

    return docs.mapInArrow(listed, "doc_id long, shingles array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with 100 * intersection >= percent * union of their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_sb"))
    # a representative may stand in many pairs: its set goes to each of them, split like any hot key
    both = join_skewed(join_skewed(pairs.select("a", "b"), left, ["a"], "inner"), right, ["b"], "inner")
    common = F.size(F.array_intersect("_sa", "_sb"))
    union = F.size("_sa") + F.size("_sb") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def linkable(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The nodes that can be similar to another of them at all.

    A set similar to ``percent`` shares that part of its own shingles with one other set, so at
    least with all others together. Repeated while it removes a tenth or more.
    """
    nodes = stored(nodes, "nodes")
    n = nodes.count()
    while n:
        own = sets.join(nodes, "node", "left_semi").select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
        often = own.groupBy("shingle").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).filter("_lo < _hi").select("shingle", "_lo")
        shared = join_skewed(own, often, ["shingle"], "inner").groupBy("node", "size").agg(F.count(F.lit(1)).alias("n"))
        nodes = stored(shared.filter(100 * F.col("n") >= percent * F.col("size")).select("node"), "nodes")
        before, n = n, nodes.count()
        if 10 * n > 9 * before:
            break
    return nodes


def long_signatures(sets: DataFrame) -> DataFrame:
    """``node, w0, w1, ..`` of ``node, shingles`` rows: BITS one-bit minimum hashes in 64-bit words."""
    schema = pa.schema([("node", pa.int64()), *((w, pa.int64()) for w in WORDS)])
    numbers = mix(np.arange(1000, 1000 + 2 * BITS, dtype=np.uint64))
    factors, shifts = numbers[:BITS] | np.uint64(1), numbers[BITS:]

    def signed(batches):
        for batch in batches:
            lists, rows = batch.column("shingles"), []
            values = np.asarray(lists.values).view(np.uint64)
            bounds = np.asarray(lists.offsets)
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = values[a:b]
                low = np.full(BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(own), 256):  # bounds the table of hashes at 4 MB
                    np.minimum(low, (own[at : at + 256, None] * factors + shifts).min(axis=0), out=low)
                rows.append(np.packbits((mix(low) & np.uint64(1)).astype(bool)).view(np.int64))
            if rows:
                words = [pa.array(w) for w in np.stack(rows, axis=1)]
                yield pa.RecordBatch.from_arrays([batch.column("node"), *words], schema=schema)

    return sets.mapInArrow(signed, ", ".join(["node long", *(f"{w} long" for w in WORDS)]))


def close_pairs(across: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of different components that share a key and are near by the long signature.

    ``across`` has ``key, node, component``. Documents of a key are dealt out to blocks of about BLOCK,
    and each block meets all documents of the key, so a hot key is work for many tasks.
    """
    differ = (1 - percent / 100) / 2
    most = int(np.ceil(BITS * differ + SIGMAS * np.sqrt(BITS * differ * (1 - differ))))
    keys = across.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    signed = long_signatures(sets.join(across.select("node").distinct(), "node", "left_semi"))
    blocks = across.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = join_skewed(across, blocks, ["key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    full = stored(dealt.join(signed.join(keys, "node"), "node"), "long")
    names = ["node", "component", "keys", *WORDS]
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    a = full.select("key", block.alias("block"), *[F.col(c).alias(f"{c}_a") for c in names])
    b = full.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *[F.col(c).alias(f"{c}_b") for c in names])
    distance = F.expr(" + ".join(f"bit_count({w}_a ^ {w}_b)" for w in WORDS))
    near = (
        (a["key"] == b["key"])
        & (a["block"] == b["block"])
        & (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (distance <= most)
        & (a["key"] == F.array_min(F.array_intersect("keys_a", "keys_b")))
    )
    return a.join(b, near).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def named(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Add the component of each node; a node without links is its own."""
    ids = found.select(F.col("id").alias("node"), F.col("component").alias("_c"))
    return join_skewed(nodes, ids, ["node"], "left").withColumn("component", F.coalesce("_c", "node")).drop("_c")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds its distinct shingles of ``k`` lower-cased words; with
    fewer words the whole sequence is one shingle. Documents are linked if their sets
    are equal or confirmed as similar to ``percent``; ``component_id`` is the smallest id
    reachable, ``kept`` marks the documents that name their component. A null or empty text
    has an empty set and no links. Rows with the same id are one document. Rows without
    an id are never linked, have a null component and are kept. An empty table gives
    no rows; other columns are left out.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(signatures(texts, k), "signatures")
    whole = signed.filter("doc_id is not null and n_shingles > 0")
    # equal sets fold into one node, the smallest id
    folded = stored(
        whole.groupBy("n_shingles", "c1", "c2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")),
        "classes",
    )
    unique = folded.select("node", "n_shingles", "c1", "c2")
    keys = ["n_shingles", "c1", "c2"]
    same = join_skewed(
        whole.select("doc_id", *keys), folded.filter("n > 1").select("node", *keys), keys, "inner"
    ).select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    heads = unique.select(F.col("node").alias("doc_id"), *keys)
    heads = whole.join(heads, ["doc_id", *keys], "left_semi").select(F.col("doc_id").alias("node"), "sig").dropDuplicates(["node"])
    index = stored(index_keys(heads), "index")
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stored(join_skewed(index, shared, ["key"], "inner"), "buckets")
    degrees = stored(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    sets = stored(
        sets_of(texts.join(degrees.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), k).select(
            F.col("doc_id").alias("node"), "shingles"
        ),
        "sets",
    )
    # first pass: the representative that shares most keys
    ranked = stored(join_skewed(buckets.drop("n"), degrees, ["node"], "inner"), "ranked")
    centres = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("m"))).alias("_r"))
    centres = centres.select("key", (-F.col("_r.m")).alias("centre"))
    best = (
        join_skewed(ranked, centres, ["key"], "inner")
        .filter("centre <> node")
        .groupBy("node", "centre")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("node")
        .agg(F.max(F.struct("n", (-F.col("centre")).alias("f"))).alias("best"))
    )
    stars = stored(best.select((-F.col("best.f")).alias("a"), F.col("node").alias("b")), "stars")
    linked = stored(confirm(stars, sets, percent), "confirmed")
    placed = stored(named(ranked.select("key", "node"), components(linked)), "placed")
    # second pass: whatever shares a key across components
    open_keys = placed.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo < _hi").select("key", "_lo")
    across = stored(join_skewed(placed, open_keys, ["key"], "inner").drop("_lo"), "across")
    able = linkable(across.select("node").distinct(), sets, percent)
    across = stored(across.join(able, "node", "left_semi"), "able")
    pairs = close_pairs(across, sets, percent)
    pairs = pairs.join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    late = confirm(stored(pairs, "late"), sets, percent)
    every = components(stored(linked.union(late).union(same), "all-links"))
    ids = every.select(F.col("id").alias("doc_id"), F.col("component").alias("_component"))
    return join_skewed(signed.select("doc_id", "n_shingles"), ids, ["doc_id"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("_component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("_component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
