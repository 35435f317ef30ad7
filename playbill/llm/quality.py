"""Host-level quality rules, on DataFrame functions only.

Each text is measured in its own row. Rule failures are summed by host (the source of a document),
each host's rate is shrunk towards the rate of all with a beta prior fitted to the hosts' own rates,
and the verdict on the host goes back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Number of words in windows of five words that occur twice or more in the list.

    Windows are compared by 64-bit hashes of their words in order. Only lists that have an equal
    pair go further: there, the windows are sorted by (hash, place), those with an equal neighbour
    are kept, and the words they cover are counted in order of place: n log n steps, no pairs.
    """
    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(placed, lambda p: bound(
            F.sort_array(F.transform(
                F.filter(F.transform(p, lambda x, k: F.struct(
                    x["i"].alias("i"),
                    ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]) | (F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)))).alias("twice"),
                )), lambda x: x["twice"]),
                lambda x: x["i"],
            )),
            lambda at: F.aggregate(
                F.transform(at, lambda place, k: F.least(F.coalesce(F.get(at, k + 1) - place, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0).cast("long"), lambda total, n: total + n),
        ))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = bound(hashes, lambda h: F.transform(
        F.slice(h, 1, F.size(h) - (WINDOW - 1)),
        lambda first, i: F.xxhash64(first, *(F.get(h, i + k) for k in range(1, WINDOW)))))
    counted = bound(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """The measures of every whole text, one row per row of docs; a NULL text has no words."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measures = bound(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(host_column).alias("host"),
        measures.alias("m"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select(
        "doc_id", "host", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words"
    ).withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def host_rates(rated: DataFrame, block_rate: float, factor: float, certainty: float) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_blocked) from rows with host and `failed`.

    The prior Beta(a, b) has the mean m of all documents and the strength a + b that the spread of
    the hosts' rates gives by the method of moments (at least 1; with no spread, 1000):
    shrunk_rate = (n_failed + a) / (n_docs + a + b). A host is blocked if that is above `block_rate`,
    or if the host is clearly worse than the others: its shrunk rate less `certainty` standard
    deviations of its posterior is above `factor` times m. A host with few documents stays near m,
    with a wide posterior. NULL is a host of its own. One row per host: a host with a third of all
    documents is counted in every task before the shuffle.
    """
    hosts = rated.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    mean = F.sum("n_failed") / F.sum("n_docs")
    # hosts weigh as much as they have documents: the rate of a tiny one says little
    prior = hosts.agg(
        mean.alias("m"),
        (F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")) / F.sum("n_docs") - mean * mean).alias("v"),
        (F.count("*") / F.sum("n_docs")).alias("inverse"),
    )
    # what the rates vary beyond counting noise is the variance of the prior, m (1 - m) / (s + 1)
    spread = F.greatest(F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("inverse"), F.lit(0.0))
    strength = F.when(spread > 0, F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.col("m") * (1 - F.col("m")) / spread - 1))).otherwise(1000.0)
    prior = prior.select("m", F.coalesce(strength, F.lit(1000.0)).alias("s"), F.lit(1).alias("one"))
    shrunk = (F.col("n_failed") + F.col("m") * F.col("s")) / (F.col("n_docs") + F.col("s"))
    deviation = F.sqrt(F.col("shrunk_rate") * (1 - F.col("shrunk_rate")) / (F.col("n_docs") + F.col("s") + 1))
    worse = F.col("shrunk_rate") - certainty * deviation > factor * F.col("m")
    return (
        hosts.withColumn("one", F.lit(1)).join(prior, "one").withColumn("shrunk_rate", shrunk)
        .select("host", "n_docs", "n_failed", "shrunk_rate", ((F.col("shrunk_rate") > block_rate) | worse).alias("host_blocked"))
    )


def verdicts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source",
             block_rate: float = 0.5, max_symbols_per_word: float = 0.3, max_dup_lines_of_words: float = 0.05, factor: float = 1.5, certainty: float = 2.0) -> DataFrame:
    """Measures and verdict for every row of docs.

    base_failed: fewer than 10 words, or more than 20 % of the words in repeated five-word windows.
    soft_failed: more symbols than `max_symbols_per_word` for each word, or more repeated lines than
    `max_dup_lines_of_words` for each word. A host is blocked if its shrunk rate of documents that fail
    either is above `block_rate`, or clearly above `factor` times the rate of all (`host_rates`). kept: false if base_failed, or if the host is blocked and the
    document fails a rule itself; a clean document stays, whatever its host. NULL hosts are one host;
    NULL or empty texts have no words and fail; equal rows get equal verdicts; an empty table gives
    no rows.
    """
    rated = measured(docs, id_column, text_column, host_column)
    rated = rated.withColumn("soft_failed", (F.col("n_symbols") > max_symbols_per_word * F.col("n_words")) | (F.col("n_dup_lines") > max_dup_lines_of_words * F.col("n_words")))
    failed = F.col("base_failed") | F.col("soft_failed")
    rated = cut_lineage(rated.withColumn("failed", failed))  # narrow rows; the texts are measured once
    rates = host_rates(rated, block_rate, factor, certainty)
    blocked = rates.where("host_blocked").select(F.col("host").alias("blocked_host"), F.lit(True).alias("blocked"))
    joined = rated.join(blocked, rated["host"].eqNullSafe(blocked["blocked_host"]), "left")
    blocked_here = F.coalesce(F.col("blocked"), F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~(blocked_here & F.col("soft_failed"))).alias("kept"))


ORACLE = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
listed AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
         [w FOR w IN string_split_regex(text, '[\x20\x09-\x0D]+') IF w <> ''] AS words,
         [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM texts),
placed AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM listed),
windows AS (
  SELECT r, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p || ' ' || lead(w, 4) OVER p AS five
  FROM placed WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM windows WHERE five IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r),
measured AS (
  SELECT listed.r, doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum([length(w) FOR w IN words]), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM listed LEFT JOIN covered USING (r)),
rated AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols > 0.3::DOUBLE * n_words OR n_dup_lines > 0.05::DOUBLE * n_words AS soft_failed
  FROM measured),
hosts AS (SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed OR soft_failed))::DOUBLE AS f FROM rated GROUP BY source),
moments AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v, count(*) / sum(n) AS inverse FROM hosts),
prior AS (
  SELECT m, CASE WHEN v - m * (1 - m) * inverse > 0
                 THEN greatest(1.0, least(1000.0, m * (1 - m) / (v - m * (1 - m) * inverse) - 1)) ELSE 1000.0 END AS s
  FROM moments),
shrunk AS (SELECT source, n + s AS strength, m, (f + m * s) / (n + s) AS rate FROM hosts, prior),
blocked AS (SELECT source, rate > 0.5 OR rate - 2.0::DOUBLE * sqrt(rate * (1 - rate) / (strength + 1)) > 1.5::DOUBLE * m AS is_blocked FROM shrunk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (is_blocked AND soft_failed) AS kept
FROM rated JOIN blocked ON rated.source IS NOT DISTINCT FROM blocked.source
"""
