"""Mixing sources to target weights, on DataFrame functions only.

Every source is cut into blocks of about `docs_per_block` documents by a hash, its blocks are put in
a permuted order, and a quota of block draws is set that reaches its target: whole passes over
the source, then a first part of the order, and of the block where that part ends the documents
that fit. A splitting tree deals the quotas of all sources out to the output shards: at
each node, the left half of the shards gets a multivariate hypergeometric share of what the node
has. A shard's share of a source is a section of the permuted order, so no block is drawn twice in a
pass; inside a shard the documents are ordered by a hash. All random choices are hashes of the
data and a seed: reruns agree.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import WORD, join_bounded
from playbill.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARD_WORDS = 200_000_000  # words of the mix in a shard


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` out of good + bad are good, by inversion of the distribution at u.

    Works upwards from twelve standard deviations below the mode, with the ratio of neighbouring
    probabilities; the number of steps grows with the root of the quotas.
    """
    good, bad, draws = (c.cast("double") for c in (good, bad, draws))
    whole = good + bad

    def search(low: Column, high: Column, mode: Column, g: Column, b: Column, n: Column) -> Column:
        def up(x: Column) -> Column:  # p(x + 1) / p(x)
            return (g - x) * (n - x) / ((x + 1) * (b - n + x + 1))

        steps_down = F.when(mode > low, F.sequence(F.lit(1).cast("long"), (mode - low).cast("long"))).otherwise(F.array().cast("array<long>"))
        at_low = F.aggregate(steps_down, F.lit(1.0), lambda p, k: p / up(mode - k))
        steps = F.when(high > low, F.sequence(F.lit(0).cast("long"), (high - low - 1).cast("long"))).otherwise(F.array().cast("array<long>"))

        def find(p_low: Column) -> Column:
            total = F.aggregate(
                steps, F.struct(p_low.alias("p"), p_low.alias("sum")),
                lambda a, k: bound(a["p"] * up(low + k), lambda p: F.struct(p.alias("p"), (a["sum"] + p).alias("sum"))),
                lambda a: a["sum"])
            return bound(total, lambda t: F.aggregate(
                steps, F.struct(p_low.alias("p"), p_low.alias("sum"), low.alias("x")),
                lambda a, k: bound(a["p"] * up(low + k), lambda p: F.struct(
                    p.alias("p"), (a["sum"] + p).alias("sum"),
                    F.when(a["sum"] < u * t, low + k + 1).otherwise(a["x"]).alias("x"))),
                lambda a: a["x"]))

        return bound(at_low, find)

    mode = F.floor((draws + 1) * (good + 1) / (whole + 2)).cast("double")
    spread = F.ceil(12 * F.sqrt(F.greatest(draws * good * bad * (whole - draws), F.lit(0.0)) / F.greatest(whole * whole * (whole - 1), F.lit(1.0)))) + 12
    first = F.greatest(F.lit(0.0), draws - bad)
    last = F.least(draws, good)
    whole_case = bound(
        F.struct(F.greatest(first, mode - spread).alias("low"), F.least(last, mode + spread).alias("high"), F.greatest(first, F.least(last, mode)).alias("mode"),
                 good.alias("g"), bad.alias("b"), draws.alias("n")),
        lambda s: search(s["low"], s["high"], s["mode"], s["g"], s["b"], s["n"]))
    return F.when(first == last, first).otherwise(whole_case).cast("long")


def with_targets(sources: DataFrame, weights: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """Adds rank, weight and target to (source, n_docs, source_size).

    target = least(limit * size, level * weight), with the level at which the targets sum to share *
    all sizes: where resharing what is above the limits ends. A few rows a source; one task.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(everything))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1))
    ranked = ranked.withColumn("most", F.lit(limit) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    everything = Window.partitionBy().orderBy("ratio", "rank")
    before, rest = everything.rowsBetween(Window.unboundedPreceding, -1), everything.rowsBetween(0, Window.unboundedFollowing)
    full = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(full) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(full))
    return ranked.withColumn("target", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))).drop("most", "ratio", "level")


def dealt(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(rank, starts): for each source, where the section of each shard starts in its draws.

    The splitting tree: a node holds the quota of each source for its shards, and each level halves
    the shards. The sources of a node are in one row, in order of rank.
    """
    item = "array<struct<rank:int,k:long>>"
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("rank").cast("int").alias("rank"), F.col("k").cast("long").alias("k")))).alias("items"))
    nodes = nodes.select(F.lit(0).alias("first"), F.lit(n_shards).alias("shards"), F.col("items").cast(item).alias("items"))
    total = lambda items: F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x["k"])
    while n_shards > 1:
        n_shards = (n_shards + 1) // 2
        left_shards = F.floor((F.col("shards") + 1) / 2).cast("int")
        nodes = nodes.withColumn("all", total(F.col("items"))).withColumn("half", F.floor(F.col("all") * left_shards / F.col("shards")).cast("long"))

        def draw(a: Column, x: Column) -> Column:
            u = uniform(F.col("first"), F.col("shards"), x["rank"], F.lit(seed))
            return bound(hypergeometric(x["k"], a["all"] - x["k"], a["half"], u), lambda got: F.struct(
                (a["half"] - got).alias("half"), (a["all"] - x["k"]).alias("all"), F.concat(a["left"], F.array(got)).alias("left")))

        left = F.aggregate(
            "items", F.struct(F.col("half").alias("half"), F.col("all").alias("all"), F.array().cast("array<long>").alias("left")), draw, lambda a: a["left"])
        nodes = nodes.withColumn("left", F.when(F.col("shards") > 1, left).otherwise(F.transform("items", lambda x: x["k"])))
        part = lambda k: F.transform("items", lambda x, i: F.struct(x["rank"].alias("rank"), k(x, F.get(F.col("left"), i)).alias("k")))
        nodes = nodes.select(F.inline(F.array(
            F.struct(F.col("first"), left_shards.alias("shards"), part(lambda x, got: got).alias("items")),
            F.struct((F.col("first") + left_shards).alias("first"), (F.col("shards") - left_shards).alias("shards"), part(lambda x, got: x["k"] - got).alias("items")),
        ))).where("shards > 0")
    rows = nodes.select(F.col("first").alias("shard"), F.inline("items"))
    order = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("k").over(order), F.lit(0)))
    return rows.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("shard", "start"))).alias("starts")).select("rank", F.col("starts.start").alias("starts"))


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS,
          share: float = 1.5, limit: float = 2.0, docs_per_block: int = 128, n_shards: int | None = None, seed: int = 42) -> DataFrame:
    """The rows of docs, all their columns as they are, with a column `mix`: struct(size, source_size,
    target, taken, shards), where `shards` has one entry for each time the mix takes the row.

    A document is taken whole, at most ceil(limit) times. NULL texts have size 0 and are taken with 0
    words; there are as many shards as `n_shards` says or the mix's words fill (SHARD_WORDS each, 16 at
    least). NULL sources are one source, the last in order; rows with equal id, source and size are
    taken equally often; an empty table gives no rows. Columns of docs may have any names but `mix`.
    """
    text, source = F.col(text_column), F.col(source_column)
    keys = F.struct(
        word_count(text).alias("size"),
        F.xxhash64(F.col(id_column), word_count(text), source, F.lit(seed)).alias("key"),
        source.alias("source"))
    slim = cut_lineage(docs.select(keys.alias("m")).groupBy("m").agg(F.count("*").alias("times")).select("m.*", "times"))
    sources = slim.groupBy("source").agg(F.sum("times").alias("n_docs"), F.sum(F.col("size") * F.col("times")).alias("source_size"))
    sources = with_targets(sources, weights, share, limit)
    sources = sources.withColumn("n_blocks", F.ceil(F.col("n_docs") / docs_per_block)).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    sources = sources.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    sources = cut_lineage(sources)
    if n_shards is None:
        mixed_words = sources.agg(F.sum("target")).first()[0] or 0.0
        n_shards = max(16, ceil(mixed_words / SHARD_WORDS))

    named = sources.select(F.col("source").alias("of_source"), "rank", "n_blocks", "passes", "rest")

    def placed(rows: DataFrame, source: Column) -> DataFrame:
        """With the number of its source and its block; the table of sources is broadcast if its
        counted size is small."""
        known = F.broadcast(named) if few else named
        return rows.join(known, source.eqNullSafe(known["of_source"]))

    few = named.count() * 200 <= 32 << 20
    cut = placed(slim, slim["source"]).withColumn("block", F.pmod("key", "n_blocks"))
    blocks = cut.groupBy("rank", "block").agg(
        F.sum(F.col("size") * F.col("times")).alias("words"), F.first("rest").alias("rest"), F.first("passes").alias("passes"), F.first("n_blocks").alias("n_blocks"))
    order = Window.partitionBy("rank").orderBy(F.xxhash64("rank", "block", F.lit(seed)), "block")
    blocks = blocks.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    blocks = blocks.withColumn("last", F.expr("CASE WHEN before + words <= rest THEN 'whole' WHEN before < rest THEN 'part' ELSE 'none' END"))
    blocks = cut_lineage(blocks)

    # the block where a source's last pass ends: its largest documents first, each that still fits
    ends = blocks.where("last = 'part'").select("rank", "block", (F.col("rest") - F.col("before")).alias("room"))
    inside = cut.join(ends, ["rank", "block"]).groupBy("rank", "block").agg(
        F.first("room").alias("room"), F.sort_array(F.collect_list(F.struct((F.col("size") * F.col("times")).alias("words"), F.col("key"))), asc=False).alias("docs"))
    fitting = F.aggregate(
        "docs", F.struct(F.col("room").alias("room"), F.array().cast("array<long>").alias("keys")),
        lambda a, x: F.when(x["words"] <= a["room"], F.struct((a["room"] - x["words"]).alias("room"), F.concat(a["keys"], F.array(x["key"])).alias("keys"))).otherwise(a),
        lambda a: a["keys"])
    inside = inside.select(F.col("rank").alias("of_rank"), F.col("block").alias("of_block"), fitting.alias("fitting"))

    quotas = blocks.groupBy("rank").agg((F.first("passes") * F.count("*") + F.sum(F.expr("CASE WHEN last = 'none' THEN 0 ELSE 1 END"))).alias("k"), F.count("*").alias("blocks_here"))
    starts = dealt(quotas, n_shards, seed).join(quotas.select("rank", "blocks_here"), "rank")
    shard_of = lambda slot: F.size(F.filter("starts", lambda s: s <= slot)) - 1
    drawn = blocks.join(starts, "rank").join(inside, (F.col("rank") == F.col("of_rank")) & (F.col("block") == F.col("of_block")), "left")
    whole_passes = F.transform(
        F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(F.array().cast("array<long>")),
        lambda i: shard_of(i * F.col("blocks_here") + F.col("place")))
    drawn = cut_lineage(drawn.select(
        F.col("rank").alias("of_rank"), F.col("block").alias("of_block"), F.col("last"), whole_passes.alias("in_passes"),
        shard_of(F.col("passes") * F.col("blocks_here") + F.col("place")).alias("in_last"), "fitting"))

    rows = docs.select(F.struct("*").alias("row"), keys.alias("k"))
    known = sources.select(F.struct("*").alias("s"))
    rows = rows.join(F.broadcast(known) if few else known, F.col("k.source").eqNullSafe(F.col("s.source")))
    rows = rows.withColumn("of_rank", F.col("s.rank")).withColumn("of_block", F.pmod("k.key", "s.n_blocks"))
    rows = join_bounded(rows, drawn, ["of_rank", "of_block"], "inner", 120)
    taken_last = (F.col("last") == "whole") | ((F.col("last") == "part") & F.coalesce(F.array_contains("fitting", F.col("k.key")), F.lit(False)))
    shards = F.when(taken_last, F.concat("in_passes", F.array("in_last"))).otherwise(F.col("in_passes"))
    mix = F.struct(F.col("k.size").alias("size"), F.col("s.source_size").alias("source_size"), F.col("s.target").alias("target"),
                   (F.col("k.size") * F.size(shards)).alias("taken"), shards.alias("shards"), F.col("k.key").alias("key"))
    return rows.select("row.*", mix.alias("mix"))


def taken_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of docs with its columns, each as often as it is taken, dealt to
    the shards and ordered by a hash inside each."""
    rows = mixed(docs, **settings)
    rows = rows.select(F.struct(*map(F.col, docs.columns)).alias("row"), F.col("mix.key").alias("key"), F.posexplode("mix.shards").alias("copy", "shard"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.xxhash64("key", "copy"), "key", "copy")
    return rows.select("row.*")
