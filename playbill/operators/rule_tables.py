"""Rules that come as tables: too many for literals in a projection, or made by other jobs.

Rules meet rows in equi-joins on something a hit must have, and what `contains` or a position says
is checked behind the join. No rule is compared with every row, and none is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GRAM, LONG_GRAM = 3, 8  # characters of a keyword that are looked up: of a short one, and of a long one
BROADCAST_ROWS = 200_000  # labels


def _grams(text: Column, size: Column | int) -> Column:
    """All runs of so many characters; none if the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i, size))


def classify_by_table(titles: DataFrame, rules: DataFrame, title: str = "title") -> DataFrame:
    """(title, type_eng, type_chi) of every different title in which a rule's keyword stands.

    ``rules`` has (rule_no, type_eng, type_chi, keyword), a row for each keyword, in lower case. The
    last rule with a keyword in the lower-cased title counts, as in ``classify``. Every keyword is
    looked up by its run of three characters, of eight if it has as many, that is the rarest among the
    rules: there are too few runs of three to tell many rules apart. Keywords that are NULL or empty
    find nothing. Equal titles are done once.
    """
    rules = rules.where(F.length("keyword") > 0).select("rule_no", "type_eng", "type_chi", "keyword").distinct()
    length = F.length("keyword")
    size = F.when(length >= LONG_GRAM, F.lit(LONG_GRAM)).otherwise(F.least(length, F.lit(GRAM)))
    spelt = rules.select("keyword").distinct().select("keyword", size.alias("size"), F.explode(F.array_distinct(_grams(F.col("keyword"), size))).alias("gram"))
    common = spelt.groupBy("gram").agg(F.count("*").alias("times"))
    anchors = spelt.join(common, "gram").groupBy("keyword", "size").agg(F.min_by("gram", F.struct("times", "gram")).alias("gram"))
    sizes = sorted(row[0] for row in anchors.select("size").distinct().collect())  # 1 to GRAM and LONG_GRAM
    named = titles.where(F.col(title).isNotNull()).select(F.col(title).alias("title")).distinct()
    if not sizes:
        return named.select("title", F.lit(None).cast("string").alias("type_eng"), F.lit(None).cast("string").alias("type_chi")).where(F.lit(False))
    spelt = F.array_distinct(F.concat(*[_grams(F.lower("title"), n) for n in sizes]))
    met = named.select("title", F.explode(spelt).alias("gram")).join(anchors.drop("size"), "gram")
    met = met.where(F.lower("title").contains(F.col("keyword"))).select("title", "keyword")
    found = met.join(rules, "keyword").groupBy("title")
    found = found.agg(F.max(F.struct("rule_no", "type_eng", "type_chi")).alias("rule"))
    return found.select("title", "rule.type_eng", "rule.type_chi")


def labels_by_table(rows: DataFrame, rules: DataFrame, keep: tuple[str, ...], source: str = "source", tokens: str = "tokens") -> DataFrame:
    """(keep…, field, value): the token behind a label, for every field that has one.

    ``rules`` has (source, field, alias, rank), aliases in lower case. A label is a whole token, in
    any case; its first place in the row counts, and of several aliases of a field the one with the
    highest rank that has a token behind it, as in ``tokens.after_label``. ``keep`` names the rows;
    rows that share a name are told together.
    """
    known = rules.select(F.col("source").alias("_source"), "field", F.col("alias").alias("_alias"), F.col("rank").alias("_rank")).distinct()
    # all tokens go through a shuffle unless the planner knows beforehand that the labels are few
    few = known.count() <= BROADCAST_ROWS
    repeated = rows.select(*[F.col(name).alias(f"_of_{name}") for name in keep]).groupBy(*[f"_of_{name}" for name in keep]).count().where("count > 1").drop("count")
    times = repeated.count()
    if times > BROADCAST_ROWS:
        return _told_by_all(_hits(rows, known, few, keep, source, tokens), keep)
    if not times:
        return _told_by_one(rows, known, few, keep, source, tokens)
    same = F.lit(True)
    for name in keep:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    single = rows.join(F.broadcast(repeated), same, "left_anti")
    several = rows.join(F.broadcast(repeated), same, "left_semi")
    return _told_by_one(single, known, few, keep, source, tokens).unionByName(_told_by_all(_hits(several, known, few, keep, source, tokens), keep))


def _hits(rows: DataFrame, known: DataFrame, few: bool, keep: tuple[str, ...], source: str, tokens: str) -> DataFrame:
    """A row for each token that is a label, with the token behind it; only the first place of a label
    in a row of tokens with a NULL, which may hide that it tells nothing."""
    following = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), F.lower(t).alias("alias"), F.get(F.col(tokens), i + 1).alias("value")))
    lowered = F.transform(tokens, F.lower)
    first = F.filter(following, lambda pair: F.array_position(lowered, pair["alias"]) == pair["at"] + 1)
    following = F.when(F.exists(tokens, lambda t: t.isNull()), first).otherwise(following)
    spread = rows.select(*keep, F.col(source).alias("_source"), F.explode(following).alias("_pair"))
    spread = spread.select(*keep, "_source", F.col("_pair.at").alias("_at"), F.col("_pair.alias").alias("_alias"), F.col("_pair.value").alias("_value"))
    return spread.join(F.broadcast(known) if few else known, ["_source", "_alias"])


def _told_by_one(rows: DataFrame, known: DataFrame, few: bool, keep: tuple[str, ...], source: str, tokens: str) -> DataFrame:
    """Where each row has a name of its own: what a row tells is found in its task, and only that is
    shuffled. A label without a token behind it is the row's last token: if it stands before, that
    place counts, and else it tells nothing. So such hits go, and of the others the first stays."""
    place = Window.partitionBy("_source", "field").orderBy("_rank", "_alias")
    known = known.select("_source", "field", "_alias", F.row_number().over(place).cast("long").alias("_no"))
    hits = _hits(rows, known, few, keep, source, tokens).where("_value IS NOT NULL")
    # the highest label, there the first place, in one number
    hits = hits.select(*keep, "field", "_value", (F.col("_no") * (1 << 32) - F.col("_at")).alias("_order"))
    return hits.groupBy(*keep, "field").agg(F.max_by("_value", "_order").alias("value"))


def _told_by_all(hits: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Where several rows have one name: their hits meet, as the first place in any of them counts."""
    first = hits.groupBy(*keep, "field", "_alias", "_rank").agg(F.min(F.struct("_at", "_value")).alias("_hit"))
    told = first.where("_hit._value IS NOT NULL").groupBy(*keep, "field")
    return told.agg(F.max_by("_hit._value", F.struct("_rank", "_alias")).alias("value"))
