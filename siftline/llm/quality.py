"""Quality rules by host.

Each document is measured and judged by rules. The share of documents of a host
that fail a rule is shrunk towards the mean of all hosts by a beta prior whose
strength comes from how much the hosts differ, so that a host with few documents
is not judged by chance. A host whose shrunk rate of any rule reaches a limit is
rejected, and with it all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import join_skewed
from .tables import SPACES, stored, text_of, words_of

# Documents of a host that fail one rule, after shrinking, from which the host is rejected.
HOST_LIMIT = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6

RULES: dict[str, str] = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)",
}
BASE_RULES = ("short", "repeats")

# The query in DuckDB's SQL: repeated windows by their words instead of by hashes, hosts' rates rule by rule.
ORACLE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT row_id, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT row_id, i, words[i:i + 7] AS w FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) >= 8)
), twice AS (
    SELECT row_id, unnest(list(i)) AS i FROM windows GROUP BY row_id, w HAVING count(*) > 1
), inside AS (
    SELECT row_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY row_id
), measured AS (
    SELECT split.row_id, doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN inside USING (row_id)
), failed AS (
    SELECT source, unnest([
        ('short', n_words < 20),
        ('repeats', 100 * n_repeat_words > 30 * n_words),
        ('symbols', 10 * n_symbols > n_words),
        ('dup_lines', 10 * n_dup_lines > 3 * n_lines),
        ('word_length', n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words))]) AS f
    FROM measured WHERE source IS NOT NULL
), hosts AS (
    SELECT source, f[1] AS rule, count(*) AS n, sum(CAST(f[2] AS INT)) AS x FROM failed GROUP BY ALL
), priors AS (
    SELECT rule, avg(x / n) AS m, var_pop(x / n) AS v FROM hosts GROUP BY rule
), strengths AS (
    SELECT rule, m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM priors
), verdicts AS (
    SELECT source, max((x + m * s) / (n + s)) >= 0.5 AS host_rejected FROM hosts JOIN strengths USING (rule) GROUP BY source
), judged AS (
    SELECT *, coalesce(host_rejected, false) AS rejected, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base
    FROM measured LEFT JOIN verdicts USING (source)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    rejected AS host_rejected, base AS base_failed, NOT base AND NOT rejected AS kept
FROM judged
"""


def has_word(line: Column) -> Column:
    return F.translate(line, SPACES, "") != ""


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each text; a null text counts as empty.

    ``n_repeat_words`` counts the words inside 8-word windows that the text holds
    twice or more. Windows are compared by 64-bit hashes, within one document only.
    """
    kept = [F.col(c) for c in docs.columns]
    width = 8
    t = text_of(text)
    steps = docs.select(
        *kept,
        words_of(t).alias("_words"),
        F.filter(F.split(t, "\n"), has_word).alias("_lines"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    ).select(
        *kept,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    names = [c for c in steps.columns if c != "_hashes"]
    empty = F.array().cast("array<bigint>")
    windows = F.when(
        F.col("n_words") >= width,
        F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - width).cast("int")),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(width)]),
        ),
    ).otherwise(empty)
    steps = steps.select(*names, windows.alias("_windows"))
    ranked = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    steps = steps.select(*names, ranked.alias("_ranked"))
    repeated = F.transform(
        "_ranked",
        lambda x, j: F.when(
            (x.h == F.get("_ranked", j + 1).h) | ((j > 0) & (x.h == F.get("_ranked", j - 1).h)), x.i
        ),
    )
    steps = steps.select(*names, F.sort_array(F.filter(repeated, lambda x: x.isNotNull())).alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda x, j: F.least(F.lit(width), F.coalesce(F.get("_at", j + 1) - x, F.lit(width)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return steps.select(*names, covered.alias("n_repeat_words"))


def host_verdicts(measured: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: ``host, n_docs, rate (the highest shrunk rate), host_rejected``.

    The prior of a rule has the mean of the hosts' rates and the strength
    mean * (1 - mean) / variance - 1, kept within 1 and 1,000,000. Rows without
    a host belong to none.
    """
    counts = (
        measured.filter(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            *[F.sum(F.expr(rule).cast("long")).alias(f"f_{name}") for name, rule in RULES.items()],
        )
    )
    priors = counts.agg(
        *[F.avg(F.col(f"f_{r}") / F.col("n_docs")).alias(f"m_{r}") for r in RULES],
        *[F.var_pop(F.col(f"f_{r}") / F.col("n_docs")).alias(f"v_{r}") for r in RULES],
    )

    def shrunk(r: str) -> Column:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        strength = F.when(v > 0, F.least(F.lit(MAX_STRENGTH), F.greatest(F.lit(MIN_STRENGTH), m * (1 - m) / v - 1)))
        strength = F.coalesce(strength, F.lit(MAX_STRENGTH))
        return (F.col(f"f_{r}") + m * strength) / (F.col("n_docs") + strength)

    # the priors are one row
    rated = counts.join(F.broadcast(priors)).select(
        "host", "n_docs", F.greatest(*[shrunk(r) for r in RULES]).alias("rate")
    )
    return rated.withColumn("host_rejected", F.col("rate") >= limit)


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Measures and verdicts: one row per input row.

    A null or empty text has no words and fails. A document without a host is
    judged by its own measures alone. Repeated rows are judged alike, an empty
    table gives no rows, other columns are left out. The measures are written once,
    without the texts, and serve both the hosts' rates and the verdicts.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    measured = stored(measure(narrow, "_text").drop("_text"), "quality")
    verdicts = host_verdicts(measured, "_host", limit).select(F.col("host").alias("_host"), "host_rejected")
    failed = F.expr(" or ".join(f"({RULES[r]})" for r in BASE_RULES))
    # the many rows of a host meet one verdict; the hash makes the adaptive skew join possible
    return (
        join_skewed(measured, verdicts, ["_host"], "left")
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("_host", "n_lines")
    )
