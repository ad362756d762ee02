"""Allow and block rules for urls, found through their rarest token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import fits_broadcast, join_skewed
from .tables import stored

TOKEN = r"[a-z0-9]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A regular expression on ``host/path``, with the literal tokens any match contains whole.

    ``weight`` ranks the rules that match one url: the highest wins, of equal ones
    the last by name.
    """

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    weight: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the url's path starts with ``path``.

    Only tokens with a boundary on both sides are sure to be whole tokens of the url, so
    a path's last token counts only if something follows it in the rule.
    """
    inner = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)
    tokens = tuple(dict.fromkeys(t.lower() for t in [*re.findall(r"[A-Za-z0-9]+", host), *inner]))
    return Rule(
        f"{host}{path}", rf"^([^/]*\.)?\Q{host}\E\Q{path}\E", verdict, tokens, len(host) + len(path)
    )


def words_rule(verdict: str, *words: str) -> Rule:
    """Fits urls whose host has the words as one hyphenated label or part of one.

    Weight 0: it decides only where no site rule fits.
    """
    name = "-".join(words)
    return Rule(f"*{name}*", rf"^[^/]*(?<![a-z0-9])\Q{name}\E(?![a-z0-9])", verdict, tuple(words), 0)


SITES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)
# Labels of advertising, gambling, adult and spam hosts.
TOPICS = (
    words_rule("block", "adult"),
    words_rule("block", "ads", "track"),
    words_rule("block", "casino"),
    words_rule("block", "cheap", "pills"),
    words_rule("block", "free", "bets"),
    words_rule("block", "spam"),
)

# The query over SITES and TOPICS in DuckDB's SQL. A word rule's word stands between ends or characters
# other than letters and digits, before the first slash.
ORACLE = r"""
WITH urls AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(name, site, start, word, verdict, weight, tokens) AS (VALUES
    ('com/', 'com', '/', NULL, 'allow', 4, ['com']),
    ('example.com/en/', 'example.com', '/en/', NULL, 'block', 15, ['example', 'com', 'en']),
    ('www.example.com/en/', 'www.example.com', '/en/', NULL, 'allow', 19, ['www', 'example', 'com', 'en']),
    ('net/es/', 'net', '/es/', NULL, 'block', 7, ['net', 'es']),
    ('net/fr/', 'net', '/fr/', NULL, 'block', 7, ['net', 'fr']),
    ('*adult*', NULL, NULL, 'adult', 'block', 0, ['adult']),
    ('*ads-track*', NULL, NULL, 'ads-track', 'block', 0, ['ads', 'track']),
    ('*casino*', NULL, NULL, 'casino', 'block', 0, ['casino']),
    ('*cheap-pills*', NULL, NULL, 'cheap-pills', 'block', 0, ['cheap', 'pills']),
    ('*free-bets*', NULL, NULL, 'free-bets', 'block', 0, ['free', 'bets']),
    ('*spam*', NULL, NULL, 'spam', 'block', 0, ['spam'])
), sites AS (SELECT DISTINCT host, path FROM urls),
tokens AS (
    SELECT host, path, unnest(list_distinct(regexp_extract_all(
        translate(host || ' ' || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+'))) AS token
    FROM sites
), frequencies AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
filed AS (
    SELECT name, first(token ORDER BY coalesce(n, 0), token) AS token
    FROM (SELECT name, unnest(tokens) AS token FROM rules) LEFT JOIN frequencies USING (token)
    GROUP BY name
), candidates AS (
    SELECT host, path, r.name, r.verdict, r.weight,
        CASE WHEN r.word IS NULL
            THEN (host = r.site OR ends_with(host, '.' || r.site)) AND starts_with(path, r.start)
            ELSE regexp_matches(host || path, '^(?:[^/]*[^/a-z0-9])?' || r.word || '(?:[^a-z0-9]|$)') END AS hit
    FROM tokens JOIN filed USING (token) JOIN rules r USING (name)
), best AS (
    SELECT host, path, count(*) AS n_candidates,
        first(name ORDER BY weight DESC, name DESC) FILTER (hit) AS name,
        first(verdict ORDER BY weight DESC, name DESC) FILTER (hit) AS verdict,
        max(weight) FILTER (hit) AS weight
    FROM candidates GROUP BY host, path
)
SELECT page_id, host, path, CASE WHEN weight > 0 THEN name END AS rule,
    coalesce(verdict, 'allow') AS verdict, coalesce(n_candidates, 0) AS n_candidates
FROM urls LEFT JOIN best USING (host, path)
"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame(
        [(r.name, r.pattern, r.verdict, list(r.tokens), r.weight) for r in rules],
        "name string, pattern string, verdict string, tokens array<string>, weight int",
    )


def index_rules(rules: DataFrame, frequencies: DataFrame) -> DataFrame:
    """The rules with the token they are filed under: the rarest of theirs in the urls.

    A token that no url holds is the rarest of all. A rule without tokens is filed under
    the empty token, which every url asks for.
    """
    filed = (
        rules.select("name", F.explode("tokens").alias("token"))
        .join(frequencies, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("_rare"))
        .select("name", F.col("_rare.token").alias("token"))
    )
    return rules.join(filed, "name", "left").select(
        "name", "pattern", "verdict", "weight", F.coalesce("token", F.lit("")).alias("token")
    )


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, n_candidates``.

    Each distinct host and path is judged once. Its tokens fetch candidate rules
    from the index, only candidates run their expression, and the heaviest match
    wins; without a match the verdict is ``allow``. The rule list may be a table; it
    is broadcast only after its size is measured. A null url, or one without ``://``,
    has an empty host and path. Repeated rows are judged alike, an empty table gives
    no rows, other columns are left out.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, rules)
    rows = stored(
        pages.select(
            F.col(id_col).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
        ),
        "urls",
    )
    sites = rows.groupBy("host", "path").count()
    asked = F.array_distinct(
        F.concat(F.array(F.lit("")), F.regexp_extract_all(F.translate(F.concat("host", F.lit(" "), "path"), UPPER, UPPER.lower()), F.lit(f"({TOKEN})"), F.lit(1)))
    )
    tokens = stored(sites.select("host", "path", F.explode(asked).alias("token")), "url-tokens")
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    small = fits_broadcast(rules.select("name", "pattern", "verdict"))
    frequencies = (
        tokens.join(F.broadcast(wanted) if small else wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )
    index = stored(index_rules(rules, frequencies), "url-rules")
    found = tokens.join(F.broadcast(index), "token") if small else join_skewed(
        # a token may file several rules; their list is one row per token
        tokens, index.groupBy("token").agg(F.collect_list(F.struct("name", "pattern", "verdict", "weight")).alias("r")), ["token"], "inner"
    ).select("host", "path", F.inline("r"))
    hit = F.rlike(F.concat("host", "path"), F.col("pattern"))
    best = (
        found.groupBy("host", "path")
        .agg(
            F.count(F.lit(1)).alias("n_candidates"),
            F.max(F.when(hit, F.struct("weight", "name", "verdict"))).alias("_best"),
        )
    )
    judged = join_skewed(rows, best, ["host", "path"], "left")
    sited = F.col("_best.weight") > 0
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(sited, F.col("_best.name")).alias("rule"),
        F.coalesce("_best.verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
    )
