"""URL rules by host suffix and path prefix, on DataFrame functions only.

Every URL is expanded into expressions host-suffix + path-prefix, as deep as the rules go. They
meet the rules in an equi-join on the first bytes of their SHA-256, the full digests confirm a hit, and the longest
rule wins. The rule side is broadcast by Spark only if its size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH_PREFIX_HEX = 8  # four bytes


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; '' for NULL and without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; '' for NULL and without ://."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows as a literal table, whose size Spark knows."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join(f"({', '.join(map(quote, rule))})" for rule in rules)
    if not values:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """The host suffixes of up to `labels` labels, each with the path's prefixes that end in its
    first to at most `slashes`-th slash; without a host none.

    That deep the rules go: a longer expression could be no rule's, so nothing is lost, and a URL of
    any length gives labels * slashes rows at most.
    """
    def count(text: Column, mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    suffixes = F.transform(F.sequence(F.lit(1), F.least(count(host, ".") + 1, F.lit(labels))), lambda i: F.call_function("substring_index", host, F.lit("."), -i))
    prefixes = F.when(
        count(path, "/") > 0,
        F.transform(F.sequence(F.lit(1), F.least(count(path, "/"), F.lit(slashes))), lambda i: F.concat(F.call_function("substring_index", path, F.lit("/"), i), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(pairs)


def judged(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", otherwise: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    A rule (host, path, verdict) fits its host and all subdomains of it, if the path of the URL
    starts with the rule's; its path begins and ends with /. The longest fitting rule wins; of rules
    with the same host and path, `block` wins. Without a fitting rule, rule is NULL and the verdict is
    `otherwise`. NULL and broken URLs have empty host and path and fit no rule. Repeated rows stay
    repeated, NULL ids stay. A rule whose path does not begin and end with / stops the job.
    """
    known = rules.select(
        F.concat("host", F.when(F.col("path").rlike("^/(.*/)?$"), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("the path of a rule begins and ends with /: "), "path")))).alias("rule"),
        F.col("verdict").alias("rule_verdict"),
    )
    known = known.groupBy("rule").agg(F.max("rule_verdict").alias("rule_verdict"))
    known = known.withColumn("rule_digest", F.sha2("rule", 256)).withColumn("bucket", F.substring("rule_digest", 1, HASH_PREFIX_HEX))

    depth = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.size(F.split("path", "/")) - 1).alias("slashes")).first()
    urls = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    # equal rows are counted, expanded once, and given back as often as they came
    urls = urls.groupBy("page_id", "url").agg(F.count("*").alias("times"))
    urls = urls.select("*", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    spread = urls.select("*", F.explode_outer(
        expressions(F.col("host"), F.col("path"), max(1, depth.labels or 1), max(1, depth.slashes or 1))).alias("expression"))
    spread = spread.withColumn("digest", F.sha2("expression", 256)).withColumn("bucket", F.substring("digest", 1, HASH_PREFIX_HEX))
    hits = spread.join(known, "bucket", "left")
    hit = F.when(F.col("digest") == F.col("rule_digest"), F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("rule_verdict")))
    best = hits.groupBy("page_id", "url").agg(F.max(hit).alias("best"), F.first("times").alias("times"))
    return best.select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(otherwise)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"),
    ).drop("copy")


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

ORACLE = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting AS (
  SELECT p.host, p.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules
    ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
  GROUP BY p.host, p.path)
SELECT page_id, parts.host, parts.path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN fitting ON parts.host = fitting.host AND parts.path = fitting.path
"""
