"""URL rules by hashed expressions.

Each URL is expanded into every (host suffix, path prefix) that a rule could
name. Expressions meet rules on four bytes of their digest, a pair counts only
if the whole digests agree, and of the rules that fit a URL the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.registry import query, table
from larkspur.llm.words import ascii_lower
from larkspur.operators.skew import skew_join

SHORT = 8  # hex digits of a digest that rules and expressions are joined on

# Fixed values of the query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; may be empty."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it: a.b.c, b.c, c."""
    labels = F.split(host, "\\.")
    parts = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(parts)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` and ``verdict``, one row for each row.

    ``rules`` has host, path and verdict (allow or block); rows with a null are
    no rules, and repeated ones count once. A rule fits its host and all hosts
    below it if the URL's path starts with the rule's path. The longest rule
    wins, and block if an allow rule is the same. Without a rule the verdict is
    ``default`` and ``rule`` is null. A null URL, or one without ``://``, has an
    empty host and path and fits no rule. Columns of ``pages`` with the names of
    the new ones are replaced.

    A row only meets the rules; rows are never compared. Rules measured small
    are copied to the tasks, a larger list is joined with hot hosts salted.
    """
    clean = rules.select(ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), "verdict").na.drop()
    clean = clean.filter("verdict IN ('allow', 'block')").distinct()
    text = F.concat("h", "p")
    clean = clean.select(
        text.alias("_rule"),
        F.struct(F.length(text).alias("n"), F.col("verdict").alias("v"), text.alias("t")).alias("_rank"),
        F.sha2(text, 256).alias("_full"),
    ).withColumn("_short", F.substring("_full", 1, SHORT))
    # as many values as there are lengths of a rule's path
    lengths = [r[0] for r in rules.select(F.length("path")).na.drop().distinct().collect()]

    base = pages.drop("host", "path", "rule", "verdict").columns
    parts = pages.select(
        F.struct(*base).alias("_page"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("_row"),
    )
    prefixes = F.filter(
        F.transform(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda n: F.substring(F.col("path"), F.lit(1), n)),
        lambda p: p.isNotNull(),
    )
    fits = F.array_distinct(
        F.flatten(F.transform(host_suffixes(F.col("host")), lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    )
    full = F.explode_outer(F.transform(fits, lambda e: F.sha2(e, 256))).alias("_digest")
    asked = parts.select("*", full).withColumn("_short", F.coalesce(F.substring("_digest", 1, SHORT), F.lit("")))
    met = skew_join(asked, clean, ["_short"], "left")
    best = F.max(F.when(F.col("_digest") == F.col("_full"), F.col("_rank"))).alias("_best")
    first = [F.first(c).alias(c) for c in ("_page", "host", "path")]
    judged = met.groupBy("_row").agg(*first, best)
    return judged.select(
        *[F.col("_page")[c].alias(c) for c in base],
        "host",
        "path",
        F.col("_best.t").alias("rule"),
        F.coalesce("_best.v", F.lit(default)).alias("verdict"),
    )


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
OP9_SQL = f"""
WITH rules(h, p, v) AS (VALUES {_RULES_SQL}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
s AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS raw FROM u),
x AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) AS path FROM s),
m AS (SELECT page_id, host, path,
             (SELECT max(struct_pack(n := length(h || p), v := v, t := h || p)) FROM rules
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM x)
SELECT page_id, host, path, best.t AS rule, coalesce(best.v, 'allow') AS verdict FROM m
"""


@query("op9_url_filter", OP9_SQL)
def op9_url_filter(spark, sf_dir):
    """Every page's URL judged by the fixed rules."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).drop("url")
