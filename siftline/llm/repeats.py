"""Repeated byte strings across documents, by merging Burrows-Wheeler transforms.

Every string of SIZE bytes (a window) has a minimizer: the GRAM-byte string in it with the
lowest hash, the first of equal ones. Equal windows have equal minimizers, so windows are
dealt to tasks by minimizer; neighbouring windows with one minimizer travel as one
piece of text. A piece that occurs again whole is folded into its earliest occurrence. A
minimizer with a single piece needs nothing more. The pieces of all other
minimizers are compared by suffix order:

A task cuts its pieces into chunks of whole minimizers, and these into shards, and builds
each shard's Burrows-Wheeler transform. The symbols are strings of STEP bytes, so a
window is DEPTH symbols. The shards are merged by refining the interleave of their
suffixes: reading each shard's transform in the present interleave and dealing it out
stably by symbol sorts the suffixes by one symbol more. The round in which two neighbours part is their common prefix. After DEPTH
rounds the blocks left are the intervals of suffixes with equal windows, and all of
a block but its earliest occurrence is repeated. No merged suffix is sorted again.

A passage with ever new surroundings gives its outer minimizers a different piece per
document. A minimizer with many different pieces is therefore split: its pieces
are single windows, dealt out by all their bytes. A sample of the texts tells which minimizers
may be so; any choice of them gives the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .arrays import mix, prefix_hashes, runs, span_hashes

SIZE = 100
GRAM = 24
STEP = 20
DEPTH = SIZE // STEP
# A shard holds about so many bytes of pieces, and the pieces merged at once, of whole minimizers, are about so many.
SHARD_BYTES = 1 << 19
CHUNK_BYTES = 1 << 21
# Different pieces of one minimizer from which it is split, as estimated from this part of the rows.
HOT_PIECES = 1 << 15
SAMPLED = 1 / 64
# Hot minimizers are known by these bits of theirs: a table of 2 MB, however many there are.
HOT_BITS = 24

FOUND = "fp long, piece long, doc_id long, start long, n int"
PIECE = pa.schema([("fp", pa.int64()), ("piece", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
CUT = pa.schema([("fp", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("text", pa.binary())])


def heads(*keys: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal keys."""
    out = np.zeros(len(keys[0]), dtype=bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def pieces_of(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """``fp, piece, text index, start, n`` of the maximal runs of windows with one minimizer.

    ``start`` is the first window's place in its text, ``n`` the number of windows, ``piece`` a hash
    of all their bytes. The windows of minimizers marked in ``hot`` are pieces of their own, and
    ``fp`` is then a hash of the window.
    """
    if len(data) < SIZE:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    sums = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(sums, at, at + GRAM)
    low = np.uint64((1 << 31) - 1)
    first = (sliding_min((grams & ~low) | at.astype(np.uint64), SIZE - GRAM + 1) & low).astype(np.int64)
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(first)]
    window = np.flatnonzero(np.arange(len(first)) + SIZE <= end)
    if not len(window):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    head = np.flatnonzero(heads(first[window], window - np.arange(len(window))))
    start = window[head]
    n = np.diff(np.append(head, len(window)))
    fp = grams[first[start]]
    split = np.zeros(len(fp), dtype=bool) if hot is None else hot[hot_place(fp)]
    if split.any():
        times = np.where(split, n, 1)
        row = np.repeat(np.arange(len(fp)), times)
        start = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        fp, n, split = fp[row], np.where(split, 1, n)[row], split[row]
    text = np.searchsorted(offsets, start, side="right") - 1
    piece = span_hashes(sums, start, start + n + SIZE - 1)
    fp[split] = mix(piece[split])
    return fp.view(np.int64), piece.view(np.int64), text, start - offsets[text], n


def hot_place(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - HOT_BITS)).astype(np.int64)


def hot_minimizers(texts: DataFrame, hot_pieces: int, sampled: float) -> np.ndarray | None:
    """Marks the places of minimizers with about ``hot_pieces`` different pieces or more; None if there are none."""
    part = texts if sampled >= 1 else texts.sample(sampled, seed=1)
    pieces = part.mapInArrow(find_pieces(), FOUND).filter("piece is not null").select("fp", "piece").distinct()
    many = pieces.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(2, hot_pieces * sampled))
    # at most 2 ** HOT_BITS places, whatever the number of minimizers
    places = many.select(F.shiftrightunsigned("fp", 64 - HOT_BITS).alias("place")).distinct().toArrow()
    if not places.num_rows:
        return None
    marks = np.zeros(1 << HOT_BITS, dtype=bool)
    marks[places.column("place").to_numpy()] = True
    return np.packbits(marks)


def fold(fp, piece, doc, start, n) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the earliest occurrence of each piece, by (fp, piece), and of all later ones."""
    order = np.lexsort((start, doc, piece, fp))
    head = heads(fp[order], piece[order])
    group = np.cumsum(head) - 1
    lead = order[head][group] if len(order) else order
    # a repeated row of one document is the same place, not a later one
    later = (doc[order] != doc[lead]) | (start[order] != start[lead])
    return order[head], order[later]


def rows_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def find_pieces(sent=None):
    """Pieces per batch, folded inside the batch: a hot piece leaves once per batch.

    Later occurrences leave as rows with ``piece`` null, spread by a hash of their place.
    ``sent`` is the broadcast table of hot minimizers.
    """

    def found(batches):
        hot = np.unpackbits(sent.value).view(bool) if sent else None
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"))
            parts = []
            for first, last, data, offsets in runs(batch.column("text")):
                fp, piece, text, start, n = pieces_of(data, offsets, hot)
                parts.append((fp, piece, ids[first:last][text], start, n))
            if not parts:
                continue
            fp, piece, doc, start, n = (np.concatenate(c) for c in zip(*parts))
            lead, later = fold(fp, piece, doc, start, n)
            yield rows_of(PIECE, fp[lead], piece[lead], doc[lead], start[lead], n[lead].astype(np.int32))
            spread = mix(doc[later].astype(np.uint64) * np.uint64(31) + start[later].astype(np.uint64)).view(np.int64)
            yield rows_of(PIECE, spread, pa.nulls(len(later), pa.int64()), doc[later], start[later], n[later].astype(np.int32))

    return found


def sift_pieces(batches):
    """Of all pieces of a task's minimizers: what is repeated for certain, and what must be compared.

    Rows of the first kind leave with ``fp`` null; of the second with their minimizer.
    """
    schema = pa.schema([f for f in CUT if f.name != "text"])
    kept = []
    for batch in batches:
        done = batch.filter(batch.column("piece").is_null())
        yield rows_of(schema, pa.nulls(done.num_rows, pa.int64()), *(done.column(c) for c in ("doc_id", "start", "n")))
        rest = batch.filter(batch.column("piece").is_valid())
        if rest.num_rows:
            kept.append([np.asarray(rest.column(c)) for c in PIECE.names])
    if not kept:
        return
    fp, piece, doc, start, n = (np.concatenate(c) for c in zip(*kept))
    lead, later = fold(fp, piece, doc, start, n)
    yield rows_of(schema, pa.nulls(len(later), pa.int64()), doc[later], start[later], n[later])
    # leads are in order of minimizer: one that stands alone is unique
    own = fp[lead]
    head = heads(own)
    alone = head & np.append(head[1:], True)
    asked = lead[~alone]
    yield rows_of(schema, fp[asked], doc[asked], start[asked], n[asked])


def cut_pieces(batches):
    """Cut the pieces asked for out of their texts; ``spans`` lists all rows of a document."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        spans = batch.column("spans")
        flat = spans.flatten()
        owner = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths()))
        fp, start, n = flat.field("fp"), np.asarray(flat.field("start")), np.asarray(flat.field("n"))
        asked = np.asarray(fp.is_valid())
        cuts, last, raw = [], -1, b""
        for i, (o, s, k, a) in enumerate(zip(owner.tolist(), start.tolist(), n.tolist(), asked.tolist())):
            if o != last and a:
                last, raw = o, texts[o].as_py()
            cuts.append(raw[s : s + k + SIZE - 1] if a else None)
        doc = np.asarray(batch.column("doc_id"))[owner]
        route = np.where(asked, np.asarray(fp.fill_null(0)), mix(doc.astype(np.uint64) * np.uint64(31) + start.astype(np.uint64)).view(np.int64))
        yield rows_of(CUT, route, doc, start, n, pa.array(cuts, pa.binary()))


class Shard:
    """The suffixes of some pieces in order, and their Burrows-Wheeler transform.

    A piece of L bytes is STEP strings of symbols, one per phase; suffix number
    ``first + o`` begins at byte ``o``, and each string ends in an end symbol, 0.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        size = lengths + 1  # suffixes of a piece: its symbols, and STEP empty ones
        first = np.cumsum(size) - size
        self.piece = np.repeat(np.arange(len(lengths)), size)
        self.offset = np.arange(size.sum()) - first[self.piece]
        full = lengths - STEP + 1
        text = np.zeros(size.sum(), dtype=np.int64)
        text[self.offset < full[self.piece]] = symbols
        rank, reach = text, STEP
        while reach < lengths.max() + STEP:
            ahead = np.zeros_like(rank)
            inside = self.offset + reach < size[self.piece]
            ahead[inside] = rank[np.flatnonzero(inside) + reach] + 1
            rank = np.unique(rank * (len(text) + np.int64(symbols.max(initial=0)) + 2) + ahead, return_inverse=True)[1]
            reach *= 2
        self.order = np.argsort(rank, kind="stable")
        before = np.zeros_like(text)
        before[self.offset >= STEP] = text[np.flatnonzero(self.offset >= STEP) - STEP]
        self.transform = before[self.order]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """``z, block``: the shard of each suffix in the order of DEPTH symbols, and its interval.

    The j-th place of a shard in ``z`` is the j-th suffix in that shard's order.
    """
    z = np.repeat(np.arange(len(shards), dtype=np.int16), [len(s.order) for s in shards])
    block = np.zeros(len(z), dtype=np.int64)
    for _ in range(DEPTH):
        symbol = np.empty(len(z), dtype=np.int64)
        by_shard = np.argsort(z, kind="stable")
        symbol[by_shard] = np.concatenate([s.transform for s in shards])
        dealt = np.argsort(symbol, kind="stable")
        z, symbol, block = z[dealt], symbol[dealt], block[dealt]
        block = np.cumsum(heads(symbol, block)) - 1
    return z, block


def repeated(texts: list[bytes], doc: np.ndarray, start: np.ndarray, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``piece, window, n``: runs of windows of the pieces that equal an earlier one."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.append(0, np.cumsum(lengths))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sums = prefix_hashes(data)
    at = np.arange(len(data))
    at = at[at + STEP <= np.repeat(offsets[1:], lengths)]
    symbols = np.unique(span_hashes(sums, at, at + STEP), return_inverse=True)[1].astype(np.int64) + 1
    of = np.append(0, np.cumsum(lengths - STEP + 1))
    cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], shard_bytes)), len(texts)))
    shards = [Shard(symbols[of[a] : of[b]], lengths[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    z, block = merge(shards)
    piece, offset = np.empty(len(z), dtype=np.int64), np.empty(len(z), dtype=np.int64)
    by_shard = np.argsort(z, kind="stable")
    piece[by_shard] = np.concatenate([s.piece[s.order] + a for s, a in zip(shards, cuts[:-1])])
    offset[by_shard] = np.concatenate([s.offset[s.order] for s in shards])
    whole = offset + SIZE <= lengths[piece]
    piece, offset, block = piece[whole], offset[whole], block[whole]
    order = np.lexsort((start[piece] + offset, doc[piece], block))
    head = heads(block[order])
    lead = order[head][np.cumsum(head) - 1]
    place = start[piece] + offset
    later = order[(doc[piece[order]] != doc[piece[lead]]) | (place[order] != place[lead])]
    later = later[np.lexsort((offset[later], piece[later]))]
    piece, offset = piece[later], offset[later]
    head = np.flatnonzero(heads(piece, offset - np.arange(len(offset))))
    return piece[head], offset[head], np.diff(np.append(head, len(offset)))


def shared_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, window, n``: the maximal runs of windows whose hash some other window of the texts has.

    Windows of different hashes are different, so the windows left out are repeated nowhere.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.append(0, np.cumsum(lengths))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at = np.arange(len(data))
    at = at[at + SIZE <= np.repeat(offsets[1:], lengths)]
    hashes = span_hashes(prefix_hashes(data), at, at + SIZE)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    text = np.searchsorted(offsets, at, side="right") - 1
    head = np.flatnonzero(heads(text, at - np.arange(len(at))))
    return text[head], (at - offsets[text])[head], np.diff(np.append(head, len(at)))


def compare_pieces(batches):
    """Rows of repeated windows from the pieces of a task; rows without text pass through.

    Pieces of one minimizer are compared together, those of several only to fill a chunk. Of
    the pieces the transforms get the stretches that share a window hash with another one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
    parts = []
    for batch in batches:
        with_text = batch.column("text").is_valid()
        parts.append(batch.filter(with_text))
        done = batch.filter(batch.column("text").is_null())
        yield rows_of(schema, *(done.column(c) for c in schema.names))
    if not any(p.num_rows for p in parts):
        return
    fp, doc, start = (np.concatenate([np.asarray(p.column(c)) for p in parts]) for c in ("fp", "doc_id", "start"))
    texts = pa.concat_arrays([p.column("text").cast(pa.large_binary()) for p in parts])
    del parts
    order = np.argsort(fp, kind="stable")
    fp, doc, start, texts = fp[order], doc[order], start[order], texts.take(pa.array(order))
    first = np.append(np.flatnonzero(heads(fp)), len(fp))
    at = np.append(0, np.cumsum(np.asarray(pc.binary_length(texts))))[first]
    # a chunk begins with the first minimizer that begins in it
    chunk = np.append(np.flatnonzero(heads(at[:-1] // CHUNK_BYTES)), len(first) - 1)
    for a, b in zip(first[chunk[:-1]].tolist(), first[chunk[1:]].tolist()):
        whole = texts[a:b].to_pylist()
        piece, window, n = shared_runs(whole)
        if not len(piece):
            continue
        cut = [whole[i][w : w + k + SIZE - 1] for i, w, k in zip(piece.tolist(), window.tolist(), n.tolist())]
        own_doc, own_start = doc[a:b][piece], start[a:b][piece] + window
        piece, window, n = repeated(cut, own_doc, own_start)
        yield rows_of(schema, own_doc[piece], own_start[piece] + window, n.astype(np.int32))


def take_out(batches):
    """Remove the windows listed in ``spans`` from each text."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out = []
        lists = batch.column("spans").to_pylist() if batch.num_rows else []
        for text, spans in zip(batch.column("text").fill_null("").cast(pa.large_binary()), lists):
            raw, left, at, removed, n_spans, last = text.as_py(), [], 0, 0, 0, -1
            for s, n in sorted((x["start"], x["n"]) for x in spans or ()):
                e = s + n + SIZE - 1
                if s > last:
                    n_spans += 1
                    left.append(raw[at:s])
                    removed += e - s
                elif e > at:
                    removed += e - at
                at = last = max(at, e)
            left.append(raw[at:])
            out.append((len(raw), removed, n_spans, hashlib.sha256(b"".join(left)).hexdigest()))
        columns = [*map(list, zip(*out))] if out else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", hot_pieces: int = HOT_PIECES, sampled: float = SAMPLED) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of SIZE bytes covers it that also starts earlier, in a document with a
    smaller id or before it in the same one. Strings are judged on the input. A null text is
    empty; texts shorter than SIZE stay whole; rows with one id are one document, so equal
    rows do not repeat each other; a row without an id has no place in the order and
    stays whole; an empty table gives no rows; other columns are left out.

    The texts are shuffled once by id and read twice from there: to cut pieces out, and to
    remove what is repeated. ``hot_pieces`` and ``sampled`` change the work's distribution only.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(id_col, text)
    if texts.dtypes != [("doc_id", "bigint"), ("text", "string")]:
        texts = texts.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # both joins take the same rows, so that they share one shuffle of the texts
    named = texts.filter("doc_id is not null")
    long_ones = named.filter(F.octet_length("text") >= SIZE)
    hot = hot_minimizers(long_ones, hot_pieces, sampled)
    pieces = long_ones.mapInArrow(find_pieces(None if hot is None else spark.sparkContext.broadcast(hot)), FOUND)
    sifted = pieces.repartition(tasks, "fp").mapInArrow(sift_pieces, "fp long, doc_id long, start long, n int")
    asked = sifted.groupBy("doc_id").agg(F.collect_list(F.struct("fp", "start", "n")).alias("spans"))
    cut = named.join(asked.hint("shuffle_merge"), "doc_id").mapInArrow(cut_pieces, "fp long, doc_id long, start long, n int, text binary")
    found = cut.repartition(tasks, "fp").mapInArrow(compare_pieces, "doc_id long, start long, n int")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    listed = named.join(spans.hint("shuffle_merge"), "doc_id", "left")
    unnamed = texts.filter("doc_id is null").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    return listed.unionByName(unnamed).mapInArrow(
        take_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
