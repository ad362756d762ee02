"""Log-probabilities of texts under an interpolated modified Kneser-Ney n-gram model.

The n-grams are counted in Spark: each task counts those of a stretch of texts, the counts
are shuffled to shards and added up. Every shard is stored as a sorted array of 64-bit
hashes and an array of counts, as a file in the shared folder. Scoring tasks map
one shard at a time into memory and look up the sorted hashes of a stretch of texts.

A text is its words, A-Z in lower case, and one end. Before it stand start marks, which
are only ever context. In the lower orders an n-gram counts its distinct left neighbours.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path
from .arrays import LOWER, mix, runs, solid_hashes, word_spans
from .tables import stored, text_of

ORDER = 2
HELD_OUT = 10
# Tokens that a task counts before it hands the counts on, and scores at once.
COUNTED_AT_ONCE = 1 << 21
SCORED_AT_ONCE = 1 << 20
# One shard for so many bytes of text, about two million tokens.
SHARD_BYTES = 12 << 20
# Words that make up this share of all tokens or more, 4096 at most, have their n-grams spread over all shards.
HOT_SHARE = 1 / 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)
START, END = (mix(np.array([x], dtype=np.uint64))[0] for x in (0x5354415254, 0x454E44))

_ROWS = "kind string, shard int, keys binary, amounts binary"
_SCHEMA = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("keys", pa.binary()), ("amounts", pa.binary())])


def token_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, tokens, bounds``: of text ``first + i`` the tokens ``bounds[i]`` to ``bounds[i + 1]``."""
    for first, last, data, offsets in runs(texts):
        starts, ends, heads = word_spans(data, offsets)
        n = np.arange(last - first)
        tokens = np.empty(len(starts) + len(n), dtype=np.uint64)
        tokens[np.arange(len(starts)) + np.repeat(n, np.diff(heads))] = solid_hashes(LOWER[data], starts, ends)
        tokens[heads[1:] + n] = END
        yield first, last, tokens, heads + np.arange(len(n) + 1)


def windows(tokens: np.ndarray, bounds: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-gram that ends at each token, one array per word of it."""
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], np.diff(bounds))
    columns = [tokens]
    for back in range(1, order):
        earlier = np.full(len(tokens), START, dtype=np.uint64)
        earlier[back:] = tokens[:-back] if len(tokens) > back else tokens[:0]
        earlier[place < back] = START
        columns.insert(0, earlier)
    return columns


def key_of(columns: list[np.ndarray]) -> np.ndarray:
    """The hash that stands for an n-gram."""
    key = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for column in columns:
        key = mix(key * _BASE + column)
    return key


def folded(ident: np.ndarray, keys: list[np.ndarray], amounts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Equal n-grams made one, in order of their hashes, with their amounts added up."""
    if not len(ident):
        return ident, keys, amounts
    order = np.argsort(ident, kind="stable")
    ident = ident[order]
    heads = np.flatnonzero(np.append(True, ident[1:] != ident[:-1]))
    return ident[heads], [k[order[heads]] for k in keys], [np.add.reduceat(a[order], heads) for a in amounts]


@dataclass
class Model:
    """Where the shards are, and the few numbers that all of them share."""

    folder: str
    order: int
    shards: int
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    tokens: int = 0
    distinct: int = 0
    # per order, from 1 on: discounts of counts 1, 2, and 3 or more
    discounts: dict[int, np.ndarray] = field(default_factory=dict)
    # of the shortest n-grams: all counts, and how many are 1, 2, and 3 or more
    base: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def shard_of(self, columns: list[np.ndarray]) -> np.ndarray:
        """N-grams of one context meet in one shard, unless the context ends in a hot word."""
        if len(columns) == 1:
            return self.shard_of_key(columns[0])
        last = columns[-2]
        near = self.hot[np.minimum(np.searchsorted(self.hot, last), max(0, len(self.hot) - 1))] == last if len(self.hot) else False
        return np.where(near | (last == START), self.shard_of_key(key_of(columns)), self.shard_of_key(key_of(columns[:-1])))

    def shard_of_key(self, key: np.ndarray) -> np.ndarray:
        return (mix(key) % np.uint64(self.shards)).astype(np.int32)


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    uri = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
    return pafs.FileSystem.from_uri(uri)


def write_shard(folder: str, name: str, shard: int, ident: np.ndarray, amounts: list[np.ndarray]) -> None:
    """Store sorted hashes and their amounts, each amount as wide as its highest value needs.

    The file gets its name when it is complete, so an attempt that was lost leaves nothing
    that counts, and a repeated one writes the same bytes.
    """
    files, path = _files(folder)
    widths = [next(w for w in (1, 2, 4, 8) if w == 8 or a.max(initial=0) < 1 << (8 * w)) for a in amounts]
    head = np.zeros(16, dtype=np.int64)
    head[0], head[1 : 1 + len(widths)] = len(ident), widths
    attempt = f"{path}/_{name}-{shard}-{uuid.uuid4().hex[:12]}"
    files.create_dir(path, recursive=True)
    with files.open_output_stream(attempt) as out:
        out.write(head.tobytes())
        out.write(ident.tobytes())
        for a, w in zip(amounts, widths):
            out.write(a.astype(f"<u{w}").tobytes())
    files.move(attempt, f"{path}/{name}-{shard}")


def mapped_shard(folder: str, name: str, shard: int) -> list[np.ndarray] | None:
    """The sorted hashes and amounts of a shard, mapped into memory; None where it has none.

    Where the shared folder has no path on the machine, the file is read instead.
    """
    files, path = _files(f"{folder}/{name}-{shard}")
    if isinstance(files, pafs.LocalFileSystem):
        try:
            raw = np.memmap(path, dtype=np.uint8, mode="r")
        except FileNotFoundError:
            return None
    else:
        if files.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with files.open_input_file(path) as source:
            raw = np.frombuffer(source.read(), dtype=np.uint8)
    head = raw[:128].view(np.int64)
    n, at, out = int(head[0]), 128, []
    for width in [8, *[int(w) for w in head[1:] if w]]:
        out.append(raw[at : at + n * width].view(f"<u{width}"))
        at += n * width
    return out


def look_up(model: Model, name: str, ident: np.ndarray, shard: np.ndarray, amounts: int) -> np.ndarray:
    """``amounts x n``: what is stored for each hash; 0 where there is nothing.

    The hashes must be distinct. One shard is mapped at a time, and read in order.
    """
    out = np.zeros((amounts, len(ident)), dtype=np.int64)
    order = np.lexsort((ident, shard))
    cuts = np.searchsorted(shard[order], np.arange(model.shards + 1))
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        found = mapped_shard(model.folder, name, s)
        if found is None or not len(found[0]):
            continue
        some = order[cuts[s] : cuts[s + 1]]
        at = np.minimum(np.searchsorted(found[0], ident[some]), len(found[0]) - 1)
        hit = found[0][at] == ident[some]
        for i in range(amounts):
            out[i, some[hit]] = found[i + 1][at[hit]]
    return out


def _packed(kind: str, shard: np.ndarray, keys: list[np.ndarray], amounts: list[np.ndarray], order_by: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per shard that holds its n-grams as arrays, word by word, then their amounts."""
    order = np.argsort(shard, kind="stable") if order_by is None else np.lexsort((order_by, shard))
    cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else []
    for first, last in zip(cuts, [*cuts[1:], len(order)]):
        some = order[first:last]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([kind]),
                pa.array([shard[some[0]]], pa.int32()),
                pa.array([b"".join(k[some].tobytes() for k in keys)], pa.binary()),
                pa.array([b"".join(a[some].astype(np.int64).tobytes() for a in amounts)], pa.binary()),
            ],
            schema=_SCHEMA,
        )


def _unpacked(table: pa.Table, keys: int, amounts: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    def columns(name: str, kind: type, width: int) -> list[np.ndarray]:
        parts = [np.frombuffer(b, dtype=kind).reshape(width, -1) for b in table.column(name).to_pylist()]
        return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, dtype=kind)] * width

    return columns("keys", np.uint64, keys), columns("amounts", np.int64, amounts)


def _stretches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """Texts taken together until they hold ``most`` tokens: their other columns, tokens and bounds."""
    held, size = [], 0
    for batch in batches:
        for first, last, tokens, bounds in token_hashes(batch.column("text")):
            held.append((batch.slice(first, last - first), tokens, bounds))
            size += len(tokens)
            if size >= most:
                yield _together(held)
                held, size = [], 0
    if held:
        yield _together(held)


def _together(held: list) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    lengths = np.concatenate([np.diff(bounds) for _, _, bounds in held])
    others = [pa.concat_arrays([batch.column(c) for batch, _, _ in held]) for c in held[0][0].schema.names if c != "text"]
    return others, np.concatenate([tokens for _, tokens, _ in held]), np.concatenate([[0], np.cumsum(lengths)])


def _merged(rows: DataFrame, merge: Callable[[pa.Table], list[pa.RecordBatch]]) -> DataFrame:
    """Bring the counts of each shard together."""

    def one(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(merge(table), schema=_SCHEMA)

    return stored(rows.groupBy("shard").applyInArrow(one, _ROWS), "grams")


def _summed(rows: DataFrame, kind: str, amounts: int) -> np.ndarray:
    """Column sums of the rows of a kind; their number is that of the shards, their size fixed."""
    total = np.zeros(amounts, dtype=np.int64)
    for row in rows.filter(F.col("kind") == kind).select("amounts").toLocalIterator():
        total += np.frombuffer(row["amounts"], dtype=np.int64)
    return total


def count_words(texts: DataFrame, model: Model, at_once: int) -> None:
    """Store how often each token occurs; fill in their number and which of them are hot."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, _ in _stretches(batches, at_once):
            words, n = np.unique(tokens, return_counts=True)
            yield from _packed("words", model.shard_of([words]), [words], [n])

    def merge(table: pa.Table) -> list[pa.RecordBatch]:
        (words,), (n,) = _unpacked(table, 1, 1)
        ident, _, (n,) = folded(words, [], [n])
        shard = table.column("shard")[0].as_py()
        write_shard(model.folder, "words", shard, ident, [n])
        # what is not hot within its shard is not hot among all
        often = n >= HOT_SHARE * n.sum()
        at = np.full(1, shard)
        return [
            *_packed("sums", at, [], [np.array([n.sum()]), np.array([len(n)])]),
            *_packed("hot", np.full(often.sum(), shard), [ident[often]], [n[often]]),
        ]

    rows = _merged(texts.mapInArrow(counted, _ROWS), merge)
    model.tokens, model.distinct = (int(x) for x in _summed(rows, "sums", 2))
    hot = []
    for row in rows.filter("kind = 'hot'").toLocalIterator():
        n = np.frombuffer(row["amounts"], dtype=np.int64)
        hot.append(np.frombuffer(row["keys"], dtype=np.uint64)[n >= HOT_SHARE * model.tokens])
    model.hot = np.sort(np.concatenate(hot)) if hot else model.hot


def discounts_of(counts: np.ndarray) -> np.ndarray:
    """Discounts from how many n-grams have a count of 1, 2, 3 and 4.

    Where a small corpus lacks one of these, or they give a value out of bounds, the
    discounts are a half, one, and one and a half.
    """
    one, two, three, four = (float(x) for x in counts)
    if min(one, two, three, four) > 0:
        y = one / (one + 2 * two)
        found = np.array([1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three])
        if (found > 0).all() and (found <= [1, 2, 3]).all():
            return found
    return np.array([0.5, 1.0, 1.5])


def count_grams(texts: DataFrame, model: Model, at_once: int) -> None:
    """Store the counts of all orders, the longest n-grams first, and what their contexts add up to."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, bounds in _stretches(batches, at_once):
            columns = windows(tokens, bounds, model.order)
            ident, columns, (n,) = folded(key_of(columns), columns, [np.ones(len(tokens), dtype=np.int64)])
            # sorted by their first words, a blob of n-grams is smaller in the shuffle
            yield from _packed("grams", model.shard_of(columns), columns, [n], columns[0])

    rows = texts.mapInArrow(counted, _ROWS)
    for order in range(model.order, 0, -1):
        rows = _merged(rows, _merge_order(model, order))
        found = _summed(rows, "sums", 6)
        model.discounts[order] = discounts_of(found[:4])
        if order == 1:
            model.base = np.array([found[4], found[0], found[1], found[5] - found[0] - found[1]], dtype=float)
        else:
            # reading the sums makes sure that all shards are written
            _summed(_merged(rows.filter("kind = 'contexts'"), _merge_contexts(model, order)), "sums", 1)
            rows = rows.filter("kind = 'grams'")


def _merge_order(model: Model, order: int) -> Callable[[pa.Table], list[pa.RecordBatch]]:
    def merge(table: pa.Table) -> list[pa.RecordBatch]:
        columns, (n,) = _unpacked(table, order, 1)
        ident, columns, (n,) = folded(key_of(columns), columns, [n])
        shard = table.column("shard")[0].as_py()
        write_shard(model.folder, f"grams{order}", shard, ident, [n])
        sums = [(n == c).sum() for c in (1, 2, 3, 4)] + [n.sum(), len(n)]
        out = list(_packed("sums", np.full(1, shard), [], [np.array([s]) for s in sums]))
        if order > 1:
            context, _, amounts = folded(key_of(columns[:-1]), [], [n, *[x.astype(np.int64) for x in (n == 1, n == 2, n > 2)]])
            out += _packed("contexts", model.shard_of_key(context), [context], amounts)
            # every distinct n-gram is one left neighbour of its last words
            _, shorter, (left,) = folded(key_of(columns[1:]), columns[1:], [np.ones(len(n), dtype=np.int64)])
            out += _packed("grams", model.shard_of(shorter), shorter, [left], shorter[0])
        return out

    return merge


def _merge_contexts(model: Model, order: int) -> Callable[[pa.Table], list[pa.RecordBatch]]:
    def merge(table: pa.Table) -> list[pa.RecordBatch]:
        (context,), amounts = _unpacked(table, 1, 4)
        ident, _, amounts = folded(context, [], amounts)
        shard = table.column("shard")[0].as_py()
        write_shard(model.folder, f"contexts{order}", shard, ident, amounts)
        return list(_packed("sums", np.full(1, shard), [], [np.array([len(ident)])]))

    return merge


def train(
    texts: DataFrame, text: str = "text", order: int = ORDER, shard_bytes: int = SHARD_BYTES, at_once: int = COUNTED_AT_ONCE
) -> Model:
    """Count the n-grams of all texts into shards in the shared folder.

    The number of shards grows with the texts, so that what one task merges does not.
    """
    texts = texts.select(text_of(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = Model(scratch_path(texts.sparkSession, "ngram"), order, max(1, -(-size // shard_bytes)))
    count_words(texts, model, at_once)
    count_grams(texts, model, at_once)
    return model


def probabilities(model: Model, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token its probability, and how often the training texts have it."""
    columns = windows(tokens, bounds, model.order)
    words, back = np.unique(tokens, return_inverse=True)
    place = model.shard_of([words])
    known = look_up(model, "words", words, place, 1)[0][back]
    p = np.full(len(tokens), 1 / (model.distinct + 1))
    for order in range(1, model.order + 1):
        own = columns[-order:]
        ident, first, back = np.unique(key_of(own), return_index=True, return_inverse=True)
        n = look_up(model, f"grams{order}", ident, model.shard_of([c[first] for c in own]), 1)[0][back].astype(float)
        if order == 1:
            all_, one, two, more = model.base
        else:
            ident, back = np.unique(key_of(own[:-1]), return_inverse=True)
            all_, one, two, more = (x[back].astype(float) for x in look_up(model, f"contexts{order}", ident, model.shard_of_key(ident), 4))
        d = model.discounts[order]
        kept = np.maximum(n - np.append(0, d)[np.minimum(n, 3).astype(int)], 0)
        seen = all_ > 0
        total = np.where(seen, all_, 1)
        p = np.where(seen, kept / total + (d[0] * one + d[1] * two + d[2] * more) / total * p, p)
    return p, known


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", at_once: int = SCORED_AT_ONCE) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, base_score, score, perplexity``.

    ``base_score`` takes each token by itself, by its count and a tenth more.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), tokens, bounds in _stretches(batches, at_once):
            p, n = probabilities(model, tokens, bounds)
            alone = np.log10((n + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))
            size = np.diff(bounds)
            sums = [np.add.reduceat(x, bounds[:-1]) for x in (n > 0, alone, np.log10(p))]
            yield pa.RecordBatch.from_arrays(
                [ids, *map(pa.array, (size, sums[0].astype(np.int64), sums[1], sums[2], 10 ** (-sums[2] / size)))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double")


def held_out(id_: Column) -> Column:
    return F.crc32(F.encode(id_.cast("string"), "UTF-8")) % HELD_OUT == 0


def judge(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER, shard_bytes: int = SHARD_BYTES, at_once: int = COUNTED_AT_ONCE
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    The model learns from rows whose crc32 of the id modulo 10 is not 0; a row without an id
    is not learnt from and not held out. A null or empty text has one token, its end. Repeated
    rows count each and score alike; without any row to learn from the scores are 0; an empty
    table gives no rows; other columns are left out.
    """
    id_ = F.col(id_col).cast("long")
    model = train(docs.filter(~held_out(id_)), text, order, shard_bytes, at_once)
    return score(docs, model, id_col, text, min(at_once, SCORED_AT_ONCE)).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )
