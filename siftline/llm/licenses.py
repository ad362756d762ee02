"""Licences of files: TF-IDF cosine of notices to templates, then inheritance from directories.

Templates are whole licence texts, standard headers and one-line notices. A text is compared
as a whole, by runs of paragraphs that hold cues, by single paragraphs, and by sentences and
lines, so that a header may be wrapped and commented as it likes. The widest part that is like
a template speaks; what lies inside it is not asked. SPDX tags are read as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.joins import join_skewed
from .license_templates import MUST, TEMPLATES
from .tables import n_words_of, stored, text_of

# Parts that may be notices.
CUE = r"(?i)licen[sc]e|copyright|spdx|public domain|permission is hereby|permission to use|permission is granted|redistribution and use|neither the name of|creative commons|\bCC[ -]BY\b|\bCC0\b"
# Names of files that speak for their directory.
NAMES = r"(?i)^(licen[sc]e|copying|notice|unlicense)([.-].*)?$"
TOKEN = r"[a-z0-9]+"
SIMILAR = 0.7

_ID = r"\(*+[A-Za-z0-9][A-Za-z0-9.+-]*+\)*+"
# Possessive, as a repeated group that may give back is matched by recursion, which a long line exhausts.
SPDX = rf"SPDX-License-Identifier:[ \t]*({_ID}(?:[ \t]++(?:AND|OR|WITH)[ \t]++{_ID})*+)"
SPDX_LINE = r"(?m)^.*SPDX-License-Identifier:.*$"
# A statement of who holds the rights, without a grant.
HOLDER = r"(?im)^[^\w\n]*(?:portions )?(?:copyright\b|\(c\)|©)(?!.*(?:licen[sc]|permi|public domain|redistribut)).*(?:\d{4}|\(c\)|©|\[yyyy\]|<year>).*$|^[^\w\n]*all rights reserved\.?[ \t]*$"
# Widths of parts.
TEXT, BLOCK, PARAGRAPH, SENTENCE, LINE = range(5)


def words_in(part: Column) -> Column:
    """The tokens of a part, joined by spaces, without the lines that name holders."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(part, HOLDER, "")), r"[^a-z0-9]+", " "))


def uncommented(text: Column) -> Column:
    """A text without comment marks; a blank line parts line comments from what is none."""
    steps = (
        (r"[\x01-\x03]", " "),
        (r"\r\n?", "\n"),
        (r"(?m)(?:\*+/|--+>)[ \t]*$", "\n"),
        (r"(?m)^[ \t]*(?:/\*+!?|<!--+)", "\x02"),
        (r"(?m)^[ \t]*(?://+!?|#+!?|\*+|--+|;+|%+|(?i:rem|dnl)(?=[ \t]))", "\x01"),
        (r"(?m)^(\x01[^\n]*\n)(?![\x01\x02])", "$1\n"),
        (r"(?m)^([^\x01\x02\n][^\n]*\n)(?=\x01)", "$1\n"),
        (r"[\x01\x02]", " "),
    )
    for pattern, to in steps:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(to))
    return text


def blocks_of(clean: Column) -> Column:
    """Runs of paragraphs that hold cues; within a run, paragraphs are one blank line apart."""
    marked = F.transform(F.split(clean, r"\n\s*\n"), lambda p: F.when(p.rlike(CUE), F.trim(p)).otherwise(F.lit("\x03")))
    runs = F.split(F.array_join(marked, "\n\n"), "\x03")
    return F.filter(F.transform(runs, lambda r: F.regexp_replace(r, r"^\n+|\n+$", "")), lambda r: r != "")


def pieces_of(paragraph: Column) -> Column:
    """Sentences, which may be wrapped, and lines of a paragraph that hold cues."""
    sentences = F.split(F.regexp_replace(paragraph, r"\s+", " "), r"(?<=[.!?]) (?=[A-Z\"(])")
    lines = F.split(paragraph, "\n")
    of = lambda parts, level: F.transform(F.filter(parts, lambda p: p.rlike(CUE)), lambda p: F.struct(F.lit(level).alias("level"), p.alias("part")))
    return F.concat(of(sentences, SENTENCE), of(lines, LINE))


def parts_of(texts: DataFrame) -> DataFrame:
    """``_row, level, b, p, part`` of ``_row, _clean`` rows: all parts, none that says what the one around it says."""
    # Rows of parts carry a digest of what is around them, not the text itself: with the text, many
    # parts would cost the square of its length.
    says = lambda part: F.md5(words_in(F.col(part)))
    whole = texts.select("_row", F.lit(TEXT).alias("level"), F.lit(-1).alias("b"), F.lit(-1).alias("p"), F.col("_clean").alias("part"))
    blocks = texts.select("_row", says("_clean").alias("text"), F.posexplode(blocks_of(F.col("_clean"))).alias("b", "block"))
    told = blocks.select("_row", "b", "block", says("block").alias("block_says"))
    paragraphs = told.select("_row", "b", "block_says", F.posexplode(F.split("block", "\n\n")).alias("p", "paragraph"))
    told = paragraphs.select("_row", "b", "p", "paragraph", says("paragraph").alias("paragraph_says"))
    pieces = told.select("_row", "b", "p", "paragraph_says", F.inline(pieces_of(F.col("paragraph"))))

    def inside(df: DataFrame, level: Column, p: Column, part: str, around: str) -> DataFrame:
        df = df.filter(says(part) != F.col(around))
        return df.select("_row", level.alias("level"), "b", p.alias("p"), F.col(part).alias("part"))

    return (
        whole.unionByName(inside(blocks, F.lit(BLOCK), F.lit(-1), "block", "text"))
        .unionByName(inside(paragraphs, F.lit(PARAGRAPH), F.col("p"), "paragraph", "block_says"))
        .unionByName(inside(pieces, F.col("level"), F.col("p"), "part", "paragraph_says"))
    )


def allowed(licenses: list[str]) -> Column:
    """The licences whose names and versions the words hold."""
    return F.filter(
        F.array(*[F.when(F.col("words").rlike(MUST[x]) if x in MUST else F.lit(True), F.lit(x)) for x in licenses]),
        lambda x: x.isNotNull(),
    )


def classify_parts(parts: DataFrame, templates, similar: float) -> DataFrame:
    """``key, license, score`` of the parts that reach ``similar``, from ``key, words, n`` rows.

    A token's weight is its count times ln((1 + N) / (1 + df)) + 1, counted over all
    parts, with their repeats, and all templates. Of equal scores the first
    licence in code point order wins.
    """
    spark = parts.sparkSession
    known = spark.createDataFrame([(i, x, t) for i, (x, t) in enumerate(templates)], "template int, license string, text string")
    known = known.select(F.format_string("template %d", "template").alias("key"), words_in(F.col("text")).alias("words"), F.lit(1).cast("long").alias("n"), "license")
    texts = parts.select("key", "words", "n", F.lit(None).cast("string").alias("license")).unionByName(known)
    counts = stored(
        texts.select("key", "n", "license", F.explode(F.split("words", " ")).alias("token"))
        .groupBy("key", "n", "license", "token")
        .agg(F.count(F.lit(1)).alias("tf")),
        "licence-tokens",
    )
    total = texts.agg(F.sum("n")).first()[0] or 0
    idf = counts.groupBy("token").agg((F.log(F.lit(1.0 + total) / (F.sum("n") + 1)) + 1).alias("idf"))
    weighted = stored(
        join_skewed(counts, idf, ["token"], "inner").withColumn("w", F.col("tf") * F.col("idf")), "licence-weights"
    )

    def norm(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))

    ours = weighted.filter("license is null").select("key", "token", "w")
    theirs = weighted.filter("license is not null").select(F.col("key").alias("template"), "license", "token", F.col("w").alias("tw"))
    template_norms = norm(weighted.filter("license is not null"), "key", "license").select(
        F.col("key").alias("template"), "license", F.col("norm").alias("t_norm")
    )
    may = parts.select("key", F.explode(allowed(sorted({x for x, _ in templates}))).alias("license"))
    # templates are a parameter list of a few hundred texts
    dots = (
        ours.join(may, "key")
        .join(F.broadcast(theirs), ["token", "license"])
        .groupBy("key", "template", "license")
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    )
    scored = (
        dots.join(F.broadcast(template_norms), ["template", "license"])
        .join(norm(ours, "key"), "key")
        .select("key", "license", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6).alias("score"))
        .filter(F.col("score") >= similar)
    )
    return (
        scored.groupBy("key")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
        .select("key", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"))
    )


def notices(texts: DataFrame, templates, similar: float) -> DataFrame:
    """``_row, license, score, noticed`` of the widest parts that are like a template, and of SPDX tags.

    ``noticed`` counts the words of the part. A tag's score is 1; of the GNU licences it tells
    the version only, as templates do, and expressions of several licences stay as they are.
    """
    tags = texts.select("_row", F.explode(F.regexp_extract_all("_clean", F.lit(SPDX), F.lit(1))).alias("tag"))
    tags = tags.select(
        "_row",
        F.regexp_replace("tag", r"\b([AL]?GPL-\d\.\d)(?:-only|-or-later|\+)", "$1").alias("license"),
        F.lit(1.0).alias("score"),
        (n_words_of(F.col("tag")) + 1).alias("noticed"),
    ).filter("license not in ('NONE', 'NOASSERTION')")
    parts = parts_of(texts.select("_row", F.regexp_replace("_clean", SPDX_LINE, "").alias("_clean")))
    parts = stored(
        parts.withColumn("words", words_in(F.col("part"))).filter("words != ''")
        .select("_row", "level", "b", "p", F.md5("words").alias("key"), "words", n_words_of(F.col("part")).alias("noticed")),
        "licence-parts",
    )
    distinct = parts.groupBy("key").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("n"))
    named = join_skewed(parts.drop("words"), classify_parts(stored(distinct, "licence-words"), templates, similar), ["key"], "inner")
    for name, within in (("_in_text", ["_row"]), ("_in_block", ["_row", "b"]), ("_in_paragraph", ["_row", "b", "p"])):
        named = named.withColumn(name, F.min("level").over(W.partitionBy(*within)))
    widest = F.when(F.col("_in_text") == TEXT, F.col("level") == TEXT).when(F.col("_in_block") == BLOCK, F.col("level") == BLOCK).otherwise(F.col("level") == F.col("_in_paragraph"))
    return named.filter(widest).select("_row", "license", "score", "noticed").unionByName(tags)


def ancestors(directory: Column) -> Column:
    """``(dir, up)`` of a directory and all above it, the root being ''. """
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda up: F.struct(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - up), "/").alias("dir"), up.alias("up")),
    )


def scan(files: DataFrame, id_col: str, path: Column, text: str = "text", templates=TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """One row per input row: ``doc_id, path, own_license, score, license, inherited_from, distance``.

    Every part of the whole text that holds a cue is compared with the templates; the
    best of the widest parts names the file's own licence. A file speaks for its directory if its
    name is that of a licence file, or if notices hold half of its words or more; of
    several the most frequent licence counts, ties by name. A file without its own
    licence takes that of its nearest ancestor directory, if there is one.
    Null and empty texts have no notices; a null path has no directory and
    inherits nothing; repeated rows are judged alike; an empty table gives no rows.
    """
    t = text_of(text)
    rows = stored(
        files.select(
            F.col(id_col).alias("doc_id"),
            path.alias("path"),
            F.when(t.rlike(CUE), uncommented(t)).alias("_clean"),
        )
        .withColumn("_words", n_words_of(F.col("_clean")))
        .withColumn("_dir", F.regexp_replace(F.regexp_replace("path", r"[^/]*$", ""), r"/+$", ""))
        .withColumn("_row", F.monotonically_increasing_id()),
        "licence-files",
    )
    own = (
        notices(rows.filter("_clean is not null").select("_row", "_clean"), templates, similar)
        .groupBy("_row")
        .agg(
            F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"),
            F.sum("noticed").alias("_noticed"),
        )
        .select("_row", F.col("best.license").alias("own_license"), (-F.col("best.s")).alias("score"), "_noticed")
    )
    judged = stored(rows.drop("_clean").join(own, "_row", "left"), "licence-own")
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    speaks = F.col("own_license").isNotNull() & F.col("_dir").isNotNull() & (
        base.rlike(NAMES) | (2 * F.col("_noticed") >= F.col("_words"))
    )
    granted = (
        judged.filter(speaks).groupBy("_dir", "own_license").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_dir").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("own_license").alias("l"))).alias("g"))
        .select(F.col("_dir").alias("dir"), F.col("g.l").alias("granted"))
    )
    # each directory looks upwards once, however many files it holds
    nearest = (
        judged.filter("_dir is not null").select("_dir").distinct()
        .select("_dir", F.inline(ancestors(F.col("_dir"))))
        .join(granted, "dir")
        .groupBy("_dir")
        .agg(F.min(F.struct("up", "dir", "granted")).alias("near"))
    )
    inherits = F.col("own_license").isNull()
    return join_skewed(judged, nearest, ["_dir"], "left").select(
        "doc_id",
        "path",
        "own_license",
        "score",
        F.coalesce("own_license", "near.granted").alias("license"),
        F.when(inherits, F.col("near.dir")).alias("inherited_from"),
        F.when(inherits, F.col("near.up")).cast("int").alias("distance"),
    )
