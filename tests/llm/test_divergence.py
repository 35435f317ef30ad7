"""Source divergence against brute force over all terms, with zeros."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from playbill.llm import divergence as D

KIND = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    found = set()
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        groups = [s for g, s in counts if g == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in groups}
        q = shares(sum((counts[lang, s] for s in groups), Counter()))
        for s in groups:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            own = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, some, most in (("pair", pair, len(pair)), ("term", own, top)):
                ranked = sorted(some, key=lambda x: (-x[1], x[0].encode()))[:most]
                found |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)}
    return found


def result(df, **settings):
    rows = [tuple(r) for r in D.audit(df, **settings).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    words = ["Ab", "aB", "é", "É", "ß", "漢字", "a1b", "x", "K", "ı", "😀z", "It's", "__", "\x7f", " q", "zz", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for i in range(n):
        text = rng.choice([None, ""]) if rng.random() < 0.1 else rng.choice([" ", "\n", "-"]).join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(30)))
        rows.append((i, text, rng.choice(["en", "en", "de", "", None]), rng.choice(sources)))
    return rows + [(n, "only once here", "xx", "s0"), (n + 1, None, "xx", "s1"), (n + 2, None, "yy", None)]


def test_against_brute_force(spark):
    rows = corpus(1, 400, ["s0", "s0", "s0", "s1", "s2", "é", "", None])
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS term", "'x' AS item", "2 AS terms", "3 AS base", "4 AS rank", "5 AS shard")
    assert result(df, least_docs=3, top=5) == brute_force(rows, 3, 5)


def test_small_memory_and_many_sources(spark):
    """Runs of 20 counts, matrices of 4 sources: the same result."""
    rows = corpus(2, 300, [f"s{i}" for i in range(23)])
    df = spark.createDataFrame(rows, KIND)
    expected = brute_force(rows, 2, 50)
    assert result(df, least_docs=2, run_entries=20, side=4, merged=30) == expected
    assert result(df.union(df), least_docs=2) == brute_force(rows + rows, 2, 50)


def test_edges(spark):
    assert result(spark.createDataFrame([], KIND)) == set()
    rows = [(i, "one two", "en", f"s{i}") for i in range(3)]
    assert result(spark.createDataFrame(rows, KIND)) == brute_force(rows, 30, 50) and brute_force(rows, 30, 50)


def test_long_text_and_hot_source(spark):
    rows = [(1, "long " * 400_000 + "x" * 1_000_000, "en", "big"), *((i, "hot words here", "en", "hot") for i in range(2, 300)), (300, "hot x", "en", "c")]
    assert result(spark.createDataFrame(rows, KIND), least_docs=1) == brute_force(rows, 1, 50)


def test_shares_are_exact(spark):
    """Beyond 64 bits in the product."""
    rng = random.Random(3)
    cases = [(n, n + rng.randrange(10**rng.randrange(1, 14)), rng.randrange(1, 10**6)) for n in (rng.randrange(10**rng.randrange(1, 14)) for _ in range(300))]
    df = spark.createDataFrame(cases, "n long, total long, v long")
    got = df.select("*", D.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 5) // (r.total + 5 * r.v) for r in got)


def test_heap_merge():
    """Blocks of seven sorted runs, by their first terms: every term comes out once, with all it has."""
    rng = random.Random(4)
    entries = sorted((bytes([rng.randrange(97, 103)]) * rng.randrange(1, 3), rng.randrange(3), rng.randrange(1, 5), 1) for _ in range(500))
    blocks = []
    for run in range(7):
        own = entries[run::7]
        blocks += [own[i : i + 9] for i in range(0, len(own), 9)]
    expected = Counter()
    for term, source, n, _ in entries:
        expected[term.decode(), f"s{source}"] += n
    for merged in (1, 40, 10_000):
        merge, found = D.Merge({}, 1, merged), []
        for block in sorted(blocks, key=lambda b: b[0][0]):
            terms, *columns = zip(*block)
            found += merge.add(terms[0], b" ".join(terms), *map(np.array, columns), ["l"] * 3, ["s0", "s1", "s2"]) or []
        found += merge.taken() or []
        got = [((term, source), n) for _, term, sources, counts in found for source, n in zip(sources, counts.tolist())]
        assert dict(got) == expected and len(got) == len(expected)
