"""Benchmark passages in documents, by greedy string tiling.

Documents and benchmark items that share a run of ``k`` tokens are joined on its Karp-Rabin
hash. For each such pair the longest common run of tokens that touches no marked token is
marked on both sides, again and again, until none of ``k`` tokens is left. The marked
share of the item's tokens tells how much of it the document holds, in any order. The
longest run is found by the rolling hashes of all runs of a length and halving that
length's bounds, so a pair of texts takes memory by the sum of their lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import gram_hashes, runs, token_spans, word_hashes
from .tables import stored

MIN_MATCH = 5
COVERAGE = 0.5
# Items of fewer tokens are not looked for: one or two words are in texts that never saw the benchmark.
MIN_ITEM = 3
# The benchmark is broadcast in blocks of about this many bytes of text, so that no
# broadcast grows with it.
BLOCK_BYTES = 8 << 20

HITS = "array<struct<item_id:bigint,covered:int,tokens:int,tiles:int>>"


def tokens_of(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """Hashes of each text's tokens, run by run: letters and digits, A-Z in lower case, marks left out."""
    for first, last, data, offsets in runs(texts):
        starts, ends, bounds = token_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        yield [words[bounds[i] : bounds[i + 1]] for i in range(last - first)]


class Seeds:
    """The runs of ``k`` tokens of a block of items, by hash."""

    def __init__(self, items: list[np.ndarray], k: int):
        grams = [gram_hashes(t, k) for t in items]
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        self.k = k
        # one entry per hash and item that has it
        every, entry = np.unique(np.concatenate([*grams, np.zeros(0, np.uint64)]), return_inverse=True)
        entry, self.owner = np.divmod(np.unique(entry.astype(np.int64) * len(items) + owner), max(1, len(items)))
        self.hashes, self.bounds = every, np.searchsorted(entry, np.arange(len(every) + 1))
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(every & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def places(self, tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each item with a run in the document, and the places there of the runs it has, item by item."""
        grams = gram_hashes(tokens, self.k)
        at = np.flatnonzero(self.maybe[(grams & np.uint64(0xFFFFF)).astype(np.int64)])
        if not len(at):
            return
        found = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        same = self.hashes[found] == grams[at]
        at, found = at[same], found[same]
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        kinds, heads = np.unique(found, return_index=True)
        tails = np.append(heads[1:], len(found))
        n = self.bounds[kinds + 1] - self.bounds[kinds]
        kind = np.repeat(np.arange(len(kinds)), n)
        owner = self.owner[np.repeat(self.bounds[kinds] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.argsort(owner, kind="stable")
        owner, kind = owner[order], kind[order]
        for mine in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
            if len(mine):
                yield int(owner[mine[0]]), np.sort(np.concatenate([at[heads[x] : tails[x]] for x in kind[mine]]))


# Rolling hashes are taken modulo this prime, to two bases; a match is compared token by token as well.
PRIME = np.uint64((1 << 31) - 1)
BASES = (1_220_703_125, 1_977_326_743)


def power_rows(size: int) -> list[np.ndarray]:
    """Powers 0 to ``size`` of each base."""
    rows = []
    for base in BASES:
        up, done = np.ones(size + 1, dtype=np.uint64), 1
        while done <= size:
            up[done : 2 * done] = up[: min(done, size + 1 - done)] * np.uint64(pow(base, done, int(PRIME))) % PRIME
            done *= 2
        rows.append(up)
    return rows


class Rolling:
    """Karp-Rabin hashes of any run of a row of tokens; with the same powers, the same wherever it stands."""

    def __init__(self, tokens: np.ndarray, powers: list[np.ndarray]):
        self.powers, self.size = powers, len(powers[0]) - 1
        self.sums = [np.append(np.uint64(0), np.cumsum(tokens % PRIME * up[: len(tokens)] % PRIME)) for up in powers]

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        one, two = ((s[at + n] - s[at]) % PRIME * up[self.size - at] % PRIME for s, up in zip(self.sums, self.powers))
        return one << np.uint64(32) | two


def free_ahead(n: int, most: int) -> np.ndarray:
    """Of each token, how many from it on are not marked, up to ``most``."""
    return np.minimum(np.arange(n, 0, -1), most)


def mark(ahead: np.ndarray, at: int, n: int, most: int) -> None:
    ahead[at : at + n] = 0
    low = max(0, at - most)
    ahead[low:at] = np.minimum(ahead[low:at], np.arange(at - low, 0, -1))


def tile(doc: np.ndarray, item: np.ndarray, places: np.ndarray, rolled: Rolling, k: int) -> tuple[int, int]:
    """Tokens of the item that are covered, and the number of tiles.

    ``places`` are those in the document where a run of ``k`` tokens of the item begins. The
    longest run comes first; of equal ones the first in the document, then in the item.
    """
    most = len(item)
    own = Rolling(item, rolled.powers)
    in_doc, in_item = free_ahead(len(doc), most), free_ahead(most, most)

    def longest_at(n: int) -> tuple[int, int] | None:
        p, q = places[in_doc[places] >= n], np.flatnonzero(in_item >= n)
        if not len(p) or not len(q):
            return None
        hashes, first = np.unique(own.of(q, n), return_index=True)
        mine = rolled.of(p, n)
        found = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
        hit = np.flatnonzero(hashes[found] == mine)
        for x in hit.tolist():
            a, b = int(p[x]), int(q[first[found[x]]])
            if np.array_equal(doc[a : a + n], item[b : b + n]):
                return a, b
        return None

    covered = tiles = 0
    low, high = k, most
    while high >= k:
        # the longest run there is has between low and high tokens, if there is one at all
        best, n = None, high
        low = k
        while low <= high:
            found = longest_at(n)
            if found:
                best, size, low = found, n, n + 1
            else:
                high = n - 1
            n = (low + high + 1) // 2
        if best is None:
            break
        mark(in_doc, best[0], size, most)
        mark(in_item, best[1], size, most)
        places = places[in_doc[places] >= k]
        covered, tiles, high = covered + size, tiles + 1, size
    return covered, tiles


class Block:
    """A block of items, made ready to be looked for."""

    def __init__(self, ids: list, texts: list, k: int, least: int):
        items = [t for run in tokens_of(pa.array(texts, pa.string())) for t in run]
        known = [(i, t) for i, t in zip(ids, items) if len(t) >= min(least, k)]
        self.ids, self.items = [i for i, _ in known], [t for _, t in known]
        # a short item has one run, itself
        sizes = np.array([min(k, len(t)) for t in self.items], dtype=np.int64)
        self.seeds = []
        for n in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == n)
            self.seeds.append((mine, Seeds([self.items[i] for i in mine], n)))

    def search(self, tokens: np.ndarray) -> list[dict]:
        """All items that share a run with a document, with what is covered of them."""
        out, rolled = [], None
        for mine, seeds in self.seeds:
            if len(tokens) < seeds.k:
                continue
            for i, places in seeds.places(tokens):
                item = self.items[mine[i]]
                size = max(len(tokens), len(item))
                if rolled is None or rolled.size < size:
                    rolled = Rolling(tokens, power_rows(size))
                covered, tiles = tile(tokens, item, places, rolled, seeds.k)
                if covered:
                    out.append({"item_id": self.ids[mine[i]], "covered": covered, "tokens": len(item), "tiles": tiles})
        return out


def tilings(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, block_bytes: int = BLOCK_BYTES, min_item: int = MIN_ITEM) -> DataFrame:
    """``doc_id, hits`` per row of ``doc_id, text``; items are ``item_id, text``.

    The items come in blocks of bounded size. Each block is one pass over the rows as
    they stream by, without a shuffle.
    """
    spark = docs.sparkSession
    items = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")), "items")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs.withColumn("hits", F.array().cast(HITS))
    hit_type = pa.list_(pa.struct([("item_id", pa.int64()), ("covered", pa.int32()), ("tokens", pa.int32()), ("tiles", pa.int32())]))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))
        last = block == blocks - 1

        def tiled(batches, sent=sent, last=last):
            block = Block(*sent.value, min_match, min_item)
            for batch in batches:
                at = 0
                for run in tokens_of(batch.column("text")):
                    part = batch.slice(at, len(run))
                    at += len(run)
                    old = part.column("hits")
                    found = [block.search(t) for t in run]
                    if blocks > 1:
                        found = [a + b for a, b in zip(old.to_pylist(), found)]
                    columns = {"doc_id": part.column("doc_id")} | ({} if last else {"text": part.column("text")})
                    yield pa.RecordBatch.from_pydict(columns | {"hits": pa.array(found, hit_type)})

        out = out.mapInArrow(tiled, f"doc_id long, hits {HITS}" if last else f"doc_id long, text string, hits {HITS}")
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES, min_item: int = MIN_ITEM) -> DataFrame:
    """One row per input row: ``doc_id, contaminated, n_items, item_ids, coverage, tiles``.

    An item is in a document if tiles of ``min_match`` tokens and more cover at least
    ``coverage`` of it; ``item_ids`` lists these items in order, ``coverage`` and ``tiles`` are those
    of the best covered item. An item of fewer than ``min_match`` tokens is found where all of it
    stands in one run; one of fewer than ``min_item`` is not looked for. Tokens are runs of
    letters and digits of any script; in scripts without spaces each character is one.
    A null or empty text holds nothing; a null id is carried along; repeated rows are
    judged alike; an empty table on either side is fine; other columns are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hits = tilings(rows, items.select("item_id", "text"), min_match, block_bytes, min_item)
    share = lambda h: h.covered / h.tokens
    inside = F.filter("hits", lambda h: share(h) >= coverage)
    best = F.array_max(F.transform("hits", lambda h: F.struct(share(h).alias("coverage"), h.tiles.alias("tiles"))))
    return hits.select(
        "doc_id",
        (F.size(inside) > 0).alias("contaminated"),
        F.size(inside).alias("n_items"),
        F.array_sort(F.transform(inside, lambda h: h.item_id)).alias("item_ids"),
        best.alias("_best"),
    ).select(
        "doc_id",
        "contaminated",
        "n_items",
        "item_ids",
        F.round(F.coalesce("_best.coverage", F.lit(0.0)), 6).alias("coverage"),
        F.coalesce("_best.tiles", F.lit(0)).alias("tiles"),
    )
