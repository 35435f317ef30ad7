"""Source divergence audit: term frequencies of sources by single-pass in-memory indexing.

1. A task reads its texts once and counts terms in memory. When the memory it may use is full, it
   spills a run: the counts sorted by term, in blocks, each block for one hash shard of the terms.
2. Every shard merges its runs with a heap. Blocks come by their first term, so all that open
   blocks hold before the next one's first term is complete; memory holds about one block a run. What
   comes out are the frequencies, whole, of the terms that enough documents of a language have.
3. Smoothed shares of two sources are compared over all kept terms without a row for the zeros: a
   pair's sum is first taken as if no source had any term, corrected by each source's own terms, and
   corrected again, streaming over the postings, by the terms that both have.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import join_bounded
from playbill.session import cut_lineage

# characters of terms: all but U+0000 to U+0040, U+005B to U+0060 and U+007B to U+007F; in UTF-8 the
# same bytes, and all bytes from 0x80 on
TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
RUN_ENTRIES, RUN_BYTES = 300_000, 64 << 20  # counts and text behind a run
BLOCK, MERGED = 4096, 1 << 16  # counts in a block; counts that open blocks hold before what is complete is taken
PAIRS, SIDE = 4_000_000, 512  # pair sums in a task's memory; sources of a term compared at once
SCALE, SMOOTH = 10**9, 5
# terms of a block are joined by spaces, which no term has; `groups` are places in langs and sources
RUN = "shard int, first binary, terms binary, groups array<int>, counts array<int>, docs array<int>, langs array<string>, sources array<string>"


def spilled(counts: dict[tuple[str, str], tuple[Counter, Counter]], shards: int) -> Iterator[pa.RecordBatch]:
    """The blocks of one run, a row each."""
    groups = list(counts)
    terms = list(chain.from_iterable(times for times, _ in counts.values()))
    if not terms:
        return
    times = np.fromiter(chain.from_iterable(t.values() for t, _ in counts.values()), np.int32, len(terms))
    docs = np.fromiter(chain.from_iterable(map(d.__getitem__, t) for t, d in counts.values()), np.int32, len(terms))
    owner = np.repeat(np.arange(len(groups)), [len(t) for t, _ in counts.values()])
    shard = np.fromiter(map(crc32, terms), np.int64, len(terms)) % shards
    sorted_ = np.array(sorted(range(len(terms)), key=terms.__getitem__))
    sorted_ = sorted_[np.argsort(shard[sorted_], kind="stable")]
    shard, owner, times, docs = shard[sorted_], owner[sorted_], times[sorted_], docs[sorted_]
    starts = np.unique(np.concatenate([np.arange(0, len(terms), BLOCK), np.flatnonzero(np.diff(shard)) + 1]))
    ends = np.append(starts[1:], len(terms))
    rows = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        own = [terms[i] for i in sorted_[a:b].tolist()]
        here, places = np.unique(owner[a:b], return_inverse=True)
        rows.append((int(shard[a]), own[0], b" ".join(own), places.astype(np.int32), times[a:b], docs[a:b], *map(list, zip(*(groups[g] for g in here), strict=True))))
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.list_(pa.int32())] * 3, *[pa.list_(pa.string())] * 2]
    names = ["shard", "first", "terms", "groups", "counts", "docs", "langs", "sources"]
    for a in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[a : a + 64], strict=True), kinds, strict=True)], names)


def runs(docs: DataFrame, shards: int, run_entries: int = RUN_ENTRIES) -> DataFrame:
    """The blocks of all runs, from (text, lang, source) without NULLs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = entries = 0
        for batch in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms = text.translate(TABLE).split()
                if not terms:
                    continue
                times, found = counts.setdefault((lang, source), (Counter(), Counter()))
                before = len(times)
                times.update(terms)
                found.update(set(terms))
                entries += len(times) - before
                size += len(text)
                if entries >= run_entries or size >= RUN_BYTES:
                    yield from spilled(counts, shards)
                    counts, size, entries = {}, 0, 0
        yield from spilled(counts, shards)

    return docs.select(F.col("text").cast("binary"), "lang", "source").mapInArrow(rows, RUN)


class Merge:
    """The merge of one shard's runs: blocks are added by their first term."""

    def __init__(self, groups: dict[tuple[str, str], int], least_docs: int, merged: int):
        self.groups, self.least_docs, self.merged = groups, least_docs, merged
        self.opened: list[tuple] = []  # a heap of (term at the place, number, place, terms, groups, counts, docs)
        self.number = self.held = 0

    def add(self, first: bytes, terms: bytes, groups: np.ndarray, counts: np.ndarray, docs: np.ndarray, langs: list[str], sources: list[str]):
        """Open a block; gives the frequencies that are complete, or None."""
        done = self.taken(first) if self.held >= self.merged else None
        known = np.array([self.groups.setdefault(pair, len(self.groups)) for pair in zip(langs, sources, strict=True)], np.int64)
        self.number += 1
        heapq.heappush(self.opened, (first, self.number, 0, terms.split(b" "), known[groups], counts, docs))
        self.held += len(counts)
        return done

    def taken(self, before: bytes | None = None) -> list[tuple] | None:
        """(lang, term, sources, counts) of the terms before a term, or of all, that are in enough
        documents of a language."""
        terms: list[bytes] = []
        parts = []
        while self.opened and (before is None or self.opened[0][0] < before):
            _, number, at, own, *columns = self.opened[0]
            to = len(own) if before is None else bisect_left(own, before, at)
            terms += own[at:to]
            parts.append([c[at:to] for c in columns])
            if to < len(own):
                heapq.heapreplace(self.opened, (own[to], number, to, own, *columns))
            else:
                heapq.heappop(self.opened)
        self.held -= len(terms)
        if not terms:
            return None
        groups, counts, docs = (np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        pairs = list(self.groups)
        places: dict[str, int] = {}
        of_lang = np.array([places.setdefault(lang, len(places)) for lang, _ in pairs], np.int64)
        langs = list(places)
        found, place = np.unique(code * len(langs) + of_lang[groups], return_inverse=True)
        seen = np.zeros(len(found), np.int64)
        np.add.at(seen, place, docs)
        wanted = seen[place] >= self.least_docs
        keys, at = np.unique(place[wanted] * len(pairs) + groups[wanted], return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, counts[wanted])
        which, of = keys // len(pairs), keys % len(pairs)
        borders = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [len(keys)]]) if len(keys) else [0]
        return [
            (langs[found[which[a]] % len(langs)], names[int(found[which[a]] // len(langs))].as_py().decode(), [pairs[g][1] for g in of[a:b]], sums[a:b])
            for a, b in zip(borders[:-1], borders[1:], strict=True)
        ]


def frequencies(blocks: DataFrame, shards: int, least_docs: int, merged: int = MERGED) -> DataFrame:
    """(lang, term, sources, counts) of the terms in at least `least_docs` documents of a language,
    with the sources that have them."""

    def batch_of(found: list[tuple] | None) -> Iterator[pa.RecordBatch]:
        if found:
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], ["lang", "term", "sources", "counts"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        last, merge = None, Merge(groups, least_docs, merged)
        for batch in batches:
            lists = [batch.column(c) for c in (3, 4, 5)]
            for i in range(len(batch)):
                shard, first, terms, langs, sources = (batch.column(c)[i].as_py() for c in (0, 1, 2, 6, 7))
                if shard != last:
                    yield from batch_of(merge.taken())
                    last, merge = shard, Merge(groups, least_docs, merged)
                yield from batch_of(merge.add(first, terms, *(x[i].values.to_numpy() for x in lists), langs, sources))
        yield from batch_of(merge.taken())

    dealt = blocks.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "first")
    return dealt.mapInArrow(rows, "lang string, term string, sources array<string>, counts array<long>")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exact: long division, as the
    product would pass 64 bits from a count of 9 * 10^9 on. The share is under 1."""
    whole = total + SMOOTH * terms
    digits, rest = F.lit(0).cast("long"), (count + SMOOTH).cast("long")
    for _ in range(3):
        rest = rest * 1000
        digits = digits * 1000 + F.call_function("div", rest, whole)
        rest = F.call_function("mod", rest, whole)
    return digits + 1


def both_have(postings: DataFrame, side: int = SIDE) -> DataFrame:
    """(lang, source, other, more): for sources that have terms in common, the sum over these terms
    of what the pair's distance is more than its bases and their own corrections say. `postings`
    has lang and `members`, the structs (source, p, base) of one term, sorted by source."""

    def excess(p: np.ndarray, base: np.ndarray, q: np.ndarray, other: np.ndarray) -> np.ndarray:
        apart = np.abs(p[:, None] - q) - np.abs(p[:, None] - other) - np.abs(base[:, None] - q)
        return apart + np.abs(base[:, None] - other)

    def found(lang: str, one: list[str], two: list[str], more: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        for i, source in enumerate(one):
            names, values = (two[i + 1 :], more[i, i + 1 :]) if same else (two, more[i])
            if names:
                columns = [[min(source, x) for x in names], [max(source, x) for x in names]]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), *map(pa.array, columns), pa.array(values)], ["lang", "source", "other", "more"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[dict[str, int], np.ndarray]] = {}  # by language: places of sources, sums of pairs

        def spill() -> Iterator[pa.RecordBatch]:
            for lang, (places, total) in sums.items():
                yield from found(lang, list(places), list(places), total[: len(places), : len(places)], True)
            sums.clear()

        for batch in batches:
            members = batch.column(1)
            starts = members.offsets.to_numpy()
            names = members.values.field(0)
            shares, bases = (members.values.field(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for lang, a, b in zip(batch.column(0).to_pylist(), starts[:-1], starts[1:], strict=True):
                own, p, base = names[a:b].to_pylist(), shares[a:b], bases[a:b]
                if b - a > side:  # too many sources for one matrix: tile by tile, given out at once
                    for i in range(0, b - a, side):
                        for j in range(i, b - a, side):
                            one, two = slice(i, i + side), slice(j, j + side)
                            yield from found(lang, own[one], own[two], excess(p[one], base[one], p[two], base[two]), i == j)
                    continue
                places, total = sums.setdefault(lang, ({}, np.zeros((16, 16), np.int64)))
                for name in own:
                    places.setdefault(name, len(places))
                if len(places) > len(total):
                    wider = np.zeros((2 * len(places),) * 2, np.int64)
                    wider[: len(total), : len(total)] = total
                    sums[lang] = places, total = places, wider
                at = [places[name] for name in own]
                total[np.ix_(at, at)] += excess(p, base, p, base)
                if sum(t.size for _, t in sums.values()) > PAIRS:
                    yield from spill()
        yield from spill()

    return postings.select("lang", "members").mapInArrow(rows, "lang string, source string, other string, more long")


def own_terms(groups: DataFrame) -> DataFrame:
    """(lang, source, other, own): for every other source of the language, the sum over the terms of
    `source` of its distance from the other's base, less the distance of the bases. `groups` has lang,
    source, base, `shares`: structs (p, times) of the source's terms, and `bases`: structs (source,
    base) of the language's sources."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, source, base, shares, bases in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = sorted((s["p"], s["times"]) for s in shares)
                p, times = np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], np.int64)
                # sums of shares and of their numbers below any base, by binary search
                sums, numbers = np.concatenate([[0], np.cumsum(p * times)]), np.concatenate([[0], np.cumsum(times)])
                others = [b for b in bases if b["source"] != source]
                other = np.array([b["base"] for b in others], np.int64)
                at = np.searchsorted(p, other)
                above = sums[-1] - sums[at] - other * (numbers[-1] - numbers[at])
                below = other * numbers[at] - sums[at]
                own = above + below - numbers[-1] * np.abs(other - base)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(others), pa.string()), pa.array([source] * len(others), pa.string()), pa.array([b["source"] for b in others], pa.string()), pa.array(own.astype(np.int64))],
                    ["lang", "source", "other", "own"])

    return groups.select("lang", "source", "base", "shares", "bases").mapInArrow(rows, "lang string, source string, other string, own long")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
          run_entries: int = RUN_ENTRIES, side: int = SIDE, merged: int = MERGED) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets the sources of a language apart.

    Terms are runs of letters A-Z and of characters from U+0080 on, only A-Z in lower case; kept are
    those in at least `least_docs` documents (rows) of the language. A term's share in a source or a
    language is smoothed and exact (`share`). Part `pair`: every other source of the language with
    the sum of the distances of all kept terms' shares. Part `term`: the `top` terms whose share in
    the source is above that in the language. Ranks by value, ties by item. NULL texts, languages
    and sources are empty text; every pair of language and source that occurs takes part, without
    terms too; equal rows all count; an empty table gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    clean = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = cut_lineage(frequencies(runs(clean, shards, run_entries), shards, least_docs, merged))

    flat = kept.select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
    flat = flat.toDF("lang", "term", "source", "n")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("lang_total"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = clean.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "lang_total"])
    # without kept terms there is nothing to divide by, and no share is used
    base = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0).alias("base")
    groups = cut_lineage(groups.select("lang", "source", "total", "terms", "lang_total", base))

    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("term_total"), F.col("lang_total"), F.col("terms"))
    whole = kept.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("term_total"), "sources", "counts")
    flat = whole.select("lang", "term", "term_total", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
    flat = flat.toDF("lang", "term", "term_total", "source", "n")
    shares = join_bounded(flat, groups, ["lang", "source"], "inner", 200).select("lang", "source", "term", p.alias("p"), q.alias("q"), "base")
    shares = cut_lineage(shares)

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    postings = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "base"))).alias("members"))
    common = both_have(postings, side).groupBy("lang", "source", "other").agg(F.sum("more").alias("more"))
    common = common.unionByName(common.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "more"))
    numbers = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("shares"))
    bases = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "base")).alias("bases"))
    sided = groups.join(numbers, ["lang", "source"], "left").join(bases, "lang").withColumn("shares", F.coalesce("shares", F.array().cast("array<struct<p:long,times:long>>")))
    own = own_terms(sided)
    mutual = own.unionByName(own.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "own"))
    mutual = mutual.groupBy("lang", "source", "other").agg(F.sum("own").alias("own"))
    facts = groups.select("lang", "source", "terms", "base")
    pairs = mutual.join(common, ["lang", "source", "other"], "left").join(facts, ["lang", "source"]).join(
        groups.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base")), ["lang", "other"])
    value = F.col("terms") * F.abs(F.col("base") - F.col("other_base")) + F.col("own") + F.coalesce("more", F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)


ORACLE = """
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
    SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counted GROUP BY lang, source),
sources AS (SELECT DISTINCT lang, source FROM docs),
dense AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
    FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
    LEFT JOIN sums t ON t.lang = s.lang AND t.source = s.source),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN dense x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN dense y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
