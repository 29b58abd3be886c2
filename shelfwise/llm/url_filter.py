"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression over a canonical URL (lower-case host, then path). The
tokens that any match must hold whole (runs of a-z and 0-9 with a separator at both ends)
are counted over the URLs, and the rule is indexed under the rarest. A URL's tokens fetch
candidate rules, and only those run their regular expression. Rules without such a token
are tried on every URL. All of it is DataFrame work: explode, join, rlike, max_by.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import pick, stored

TOKEN = r"[a-z0-9]+"

# Host and path rules; the longest that fits a URL decides. Fixed values of the contract.
SITE_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

# What decides URLs that no site rule fits: pattern rules, any of which blocks; else allow.
BLOCK_PATTERNS = [
    r"(^|[./-])cheap-pills[./-]",
    r"(^|[./-])casino-win[./-]",
    r"(^|[./-])spam-farm[./-]",
    r"(^|[./-])adult-site[./-]",
]


def site_pattern(rule: str) -> str:
    """A host and path rule as a pattern: its host and all subdomains, paths that start so."""
    return r"^([^/]*\.)?" + re.escape(rule)


def site_tokens(rule: str) -> list[str]:
    """Tokens that stand whole in every URL that the rule fits: all but one at its open end."""
    return [m[0] for m in re.finditer(TOKEN, rule.lower()) if m.end() < len(rule)]


def pattern_tokens(pattern: str) -> list[str]:
    """Whole tokens of a pattern of the form ``separator literal separator``; of others none."""
    m = re.fullmatch(r"\(\^\|\[\./-\]\)([a-z0-9-]+)\[\./-\]", pattern)
    return re.findall(TOKEN, m[1]) if m else []


def rule_rows() -> list[tuple[str, str, str, list[str]]]:
    """(rule, verdict, pattern, whole tokens): site rules by their text, pattern rules by their pattern."""
    site = [(r, v, site_pattern(r), site_tokens(r)) for r, v in SITE_RULES]
    return site + [(p, "block", p, pattern_tokens(p)) for p in BLOCK_PATTERNS]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(pages: DataFrame) -> DataFrame:
    rest = F.expr("if(instr(url, '://') > 0, substring(url, instr(url, '://') + 3), '')")
    stem = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^?#]*", 0)
    return pages.withColumn("stem", stem).select(
        "page_id", "url", lower_ascii(F.regexp_extract("stem", r"^[^/]*", 0)).alias("host"),
        F.regexp_extract("stem", r"^[^/]*([\s\S]*)$", 1).alias("path"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str, list[str]]] | None = None,
          site: frozenset[str] = frozenset(r for r, _ in SITE_RULES)) -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict.

    ``rule`` is the longest site rule that fits (else null) and ``verdict`` is its verdict;
    where none fits, a pattern rule that matches blocks and everything else is allowed. A
    null url or one without ``://`` has an empty host and path, fits nothing and is allowed.
    Null page_ids and repeated rows are judged each; other columns are not read.
    """
    spark = pages.sparkSession
    rules = rule_rows() if rules is None else rules
    parts = with_parts(pick(pages, "page_id", "url"))
    urls = stored(parts.select("host", "path").distinct(), "urls")
    words = urls.select("host", "path", F.explode(F.array_distinct(F.expr(
        f"regexp_extract_all(lower(concat(host, path)), '{TOKEN}', 0)"))).alias("token"))
    table = spark.createDataFrame(
        [(r, v, p, t or None, r in site) for r, v, p, t in rules],
        "rule string, verdict string, pattern string, tokens array<string>, site boolean")
    # The rules come from the driver's list, so they are small, and no common token is dealt to one task.
    literal = table.select("rule", F.explode("tokens").alias("token"))
    seen = words.join(F.broadcast(literal.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = literal.join(seen, "token", "left").groupBy("rule").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    index = table.join(rarest, "rule", "left").select("rule", "verdict", "pattern", "site", "token")
    fetched = words.join(F.broadcast(index.where("token is not null")), "token").drop("token")
    # Rules without a whole token: as many as the rule list says, tried on each URL in its row.
    loose = [(r, v, p, r in site) for r, v, p, t in rules if not t]
    tried = urls.select("host", "path", F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("pattern"),
                 F.lit(s).alias("site")) for r, v, p, s in loose))).alias("x")).select("host", "path", "x.*") if loose else None
    candidates = fetched.unionByName(tried) if tried is not None else fetched
    hits = candidates.where(F.expr("rlike(concat(host, path), pattern)"))
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("any"),
        F.max(F.when(F.col("site"), F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("best"))
    judged = parts.join(best, ["host", "path"], "left")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "any.verdict", F.lit("allow")).alias("verdict"))


def oracle() -> str:
    """The same as DuckDB SQL, each rule tried on each URL."""
    fits = "\n".join(
        f"""    UNION ALL SELECT page_id, host, path, '{r}' AS rule, '{v}' AS verdict FROM parts
      WHERE (host = '{r.split("/", 1)[0]}' OR ends_with(host, '.{r.split("/", 1)[0]}'))
        AND starts_with(path, '/{r.split("/", 1)[1]}')""" for r, v in SITE_RULES).lstrip().removeprefix("UNION ALL ")
    block = " OR ".join(f"regexp_matches(concat(host, path), '{p}')" for p in BLOCK_PATTERNS)
    return f"""
WITH stems AS (
  SELECT page_id, regexp_extract(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END,
                                 '^[^?#]*') AS stem
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(stem, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(stem, length(regexp_extract(stem, '^[^/]*')) + 1) AS path
  FROM stems),
fits AS (
    {fits}),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule,
       coalesce(b.verdict, CASE WHEN {block} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""
