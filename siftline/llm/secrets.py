"""Secrets in texts: fixed patterns, and random strings told from identifiers by Markov models.

Everything on the way from text to spans is DataFrame functions. A position in a text is
found without a Python loop: each match is extracted together with all that lies
between it and the match before, so that lengths add up to positions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .tables import stored, text_of

ASSIGN = r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
# A run that is long enough is the same leftmost match as any run with the short ones dropped.
ACCESS = r"(AKIA[A-Z0-9]{12,})"
HEX = r"([0-9a-f]{32,})"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"([A-Za-z0-9+/_=-]{20,})"
# What counts as an ordinary identifier in training: words, joined or numbered, and numbers. The repeats are
# possessive: a repeated group that may give back is matched by recursion, which a long identifier exhausts.
ORDINARY = r"(?<![A-Za-z0-9+/_=-])((?=[A-Za-z0-9_-]{8})(?:[A-Za-z]++(?:[_-][A-Za-z]++)*+[0-9]{0,3}|[0-9]++))(?![A-Za-z0-9+/_=-])"
# The labelled sample: identifiers from so many documents, and so many random strings of each kind.
SAMPLE_DOCS = 2000
SAMPLE_RANDOM = 1000
# Log-likelihood ratio in nats from which a token counts as random.
LIMIT = 8.0
# Rulers and runs of a few characters are not random, whatever a chain of pairs says.
DISTINCT = 6

SPAN = "array<struct<start:int,kind:int,end:int,ok:boolean>>"
# Spans are gathered in blocks of this length.
BLOCK = 256


def matches(text: Column, pattern: str, may: Column, group: int, least: int) -> Column:
    """Spans of all leftmost matches; ``ok`` tells if the group has ``least`` characters.

    ``\\G`` ties each search to the end of the last match: a text without another match is
    scanned once. ``may`` is a cheap test that skips most texts.
    """
    with_gap = F.lit(rf"(?s)\G.*?{pattern}")
    pieces = F.when(may, F.regexp_extract_all(text, with_gap, F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.transform(
        pieces,
        lambda piece: F.struct(
            F.length(piece).alias("size"),
            F.length(F.regexp_extract(piece, rf"(?s)^.*?{pattern}$", 1)).alias("own"),
            (F.length(F.regexp_extract(piece, rf"(?s)^.*?{pattern}$", group)) >= least).alias("ok"),
        ),
    )


def grow(full: Column, out: Column, s: Column) -> tuple[Column, Column]:
    """``full, out`` with one more span: a block that is full moves to ``full`` as a whole.

    Appending copies an array, so one long array would cost the square of its length.
    """
    filled = F.size(out) >= BLOCK
    return F.when(filled, F.array_append(full, out)).otherwise(full), F.when(filled, F.array(s)).otherwise(F.array_append(out, s))


def positions(found: Column, kind: int) -> Column:
    """Turn sizes of consecutive pieces into spans."""
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("full"), none.alias("out"))

    def add(state: Column, m: Column) -> Column:
        end = state.at + m["size"]
        span = F.struct((end - m.own).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m.ok.alias("ok"))
        full, out = grow(state.full, state.out, span)
        return F.struct(end.alias("at"), full.alias("full"), out.alias("out"))

    spans = F.aggregate(found, start, add, lambda s: F.flatten(F.array_append(s.full, s.out)))
    return F.when(F.size(found) > 0, spans).otherwise(none)


def untouched(spans: Column, base: Column) -> Column:
    """The spans, none of which overlap, that no base span touches: one sweep over both in order.

    A base span before a span may reach into it; one after its start takes it back.
    """
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("reach"), F.array().cast(f"array<{SPAN}>").alias("full"), none.alias("out"))

    def add(state: Column, s: Column) -> Column:
        is_base = s.kind != len(KINDS) - 1
        free = ~is_base & (state.reach <= s.start)
        back = is_base & F.coalesce(F.get(state.out, F.size(state.out) - 1)["end"] > s.start, F.lit(False))
        full, out = grow(state.full, state.out, s)
        return F.struct(
            F.when(is_base, F.greatest(state.reach, s.end)).otherwise(state.reach).alias("reach"),
            F.when(free, full).otherwise(state.full).alias("full"),
            F.when(free, out).when(back, F.slice(state.out, F.lit(1), F.size(state.out) - 1)).otherwise(state.out).alias("out"),
        )

    left = F.aggregate(F.sort_array(F.concat(base, spans)), start, add, lambda s: F.flatten(F.array_append(s.full, s.out)))
    return F.when(F.size(spans) > 0, left).otherwise(none)


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns in order of start, then kind."""
    every = F.concat(
        positions(matches(text, ASSIGN, F.lit(True), 2, 8), 0),
        positions(matches(text, ACCESS, F.contains(text, F.lit("AKIA")), 1, 16), 1),
        positions(matches(text, HEX, F.lit(True), 1, 32), 2),
    )
    return F.sort_array(F.filter(every, lambda s: s.ok))


def bigrams(strings: DataFrame, column: str) -> DataFrame:
    """Counts of neighbouring characters of the alphabet: ``a, b, n``."""
    # the characters beside themselves moved by one; cutting each pair out of a long string would cost its square
    characters = F.split(column, "")
    pair = F.explode(F.zip_with(characters, F.slice(characters, F.lit(2), F.length(column)), lambda a, b: F.concat(a, b)))
    return (
        strings.filter(F.length(column) > 1)
        .select(pair.alias("pair"))
        .filter(F.length("pair") == 2)
        .groupBy(F.substring("pair", 1, 1).alias("a"), F.substring("pair", 2, 1).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def train(docs: DataFrame, id_col: str, text: str, sample_docs: int = SAMPLE_DOCS, sample_random: int = SAMPLE_RANDOM) -> np.ndarray:
    """Log-likelihood ratios of transitions, random against ordinary, as a flat table.

    The labelled sample is bounded. Ordinary strings are the identifiers of 8 characters and
    more in the ``sample_docs`` documents with the lowest hash of the id, apart from
    what the fixed patterns find. Random ones are those findings, and ``sample_random``
    digests each in hexadecimal of either case, base 64 and capitals with digits. The counts that reach the driver
    are bounded by the square of the alphabet. Each model is a first-order chain with
    half a count added to every transition.
    """
    ids = (
        docs.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct()
        .orderBy(F.xxhash64("_id"), "_id").limit(sample_docs)
    )
    # at most sample_docs ids
    sample = docs.select(F.col(id_col).alias("_id"), text_of(text).alias("_t")).join(F.broadcast(ids), "_id")
    secret = F.concat_ws("|", F.lit(ASSIGN), F.lit(ACCESS), F.lit(HEX))
    labelled = stored(
        sample.select(
            F.regexp_extract_all("_t", secret, F.lit(0)).alias("random"),
            F.regexp_extract_all(F.regexp_replace("_t", secret, F.lit(" ")), F.lit(ORDINARY), F.lit(1)).alias("ordinary"),
        ),
        "secret-sample",
    )
    digest = F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 256)
    made = docs.sparkSession.range(sample_random).select(
        F.explode(
            F.array(
                digest,
                F.upper(digest),
                F.base64(F.unhex(digest)),
                F.translate(F.upper(F.base64(F.unhex(digest))), "+/=", ""),
            )
        ).alias("s")
    )
    value = F.regexp_extract("r", r"([A-Za-z0-9+/_=-]+)$", 1)
    positive = made.unionByName(labelled.select(F.explode("random").alias("r")).select(value.alias("s")))
    negative = labelled.select(F.explode("ordinary").alias("s"))
    place = {c: i for i, c in enumerate(ALPHABET)}

    def chain(strings: DataFrame) -> np.ndarray:
        counts = np.full((len(ALPHABET), len(ALPHABET)), 0.5)
        for a, b, n in bigrams(strings, "s").collect():
            if a in place and b in place:
                counts[place[a], place[b]] += n
        return np.log(counts / counts.sum(axis=1, keepdims=True))

    return (chain(positive) - chain(negative)).round(6).ravel()


def random_spans(text: Column, base: Column, ratios: np.ndarray, limit: float) -> Column:
    """Spans of tokens whose ratio reaches the limit and that no base span touches."""
    table = F.lit(ratios)
    code = F.lit(np.array([ALPHABET.find(chr(i)) for i in range(128)], dtype=np.int32))

    def ratio(token: Column) -> Column:
        codes = F.transform(F.split(token, ""), lambda c: F.get(code, F.ascii(c)))
        return F.aggregate(
            codes,
            F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
            lambda s, c: F.struct(
                c.alias("last"),
                (s["sum"] + F.when(s["last"] < 0, F.lit(0.0)).otherwise(F.get(table, s["last"] * len(ALPHABET) + c))).alias("sum"),
            ),
            lambda s: s["sum"],
        )

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?{TOKEN}"), F.lit(0))
    found = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p).alias("size"),
            F.length(F.regexp_extract(p, f"{TOKEN}$", 1)).alias("own"),
            (
                (F.size(F.array_distinct(F.split(F.regexp_extract(p, f"{TOKEN}$", 1), ""))) >= DISTINCT)
                & (ratio(F.regexp_extract(p, f"{TOKEN}$", 1)) >= limit)
            ).alias("ok"),
        ),
    )
    return untouched(F.filter(positions(found, 3), lambda s: s.ok), base)


def joined(spans: Column) -> Column:
    kind = F.lit(np.array(KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kind, s.kind), s.start.cast("string"), s.end.cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: float = LIMIT) -> DataFrame:
    """One row per input row: ``doc_id, base (spans), all_spans``.

    Spans are (start, kind, end, ok) in code points, end exclusive, by start, then kind.
    A null or empty text has none; repeated rows are scanned alike; an empty table
    gives no rows; other columns are left out. Whole texts are scanned.
    """
    ratios = train(docs, id_col, text)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text).alias("_text"))
    rows = rows.withColumn("base", base_spans(F.col("_text")))
    rows = rows.withColumn("random", random_spans(F.col("_text"), F.col("base"), ratios, limit))
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", "random")).alias("all_spans"))


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``scan``'s rows."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("all_spans")).alias("spans"),
        (F.size("all_spans") - F.size("base")).cast("long").alias("n_random"),
    )
