"""The operators on DataFrame functions: URL rules, quality, mixing; each on odd rows too."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playbill.llm import mixing, quality, urls


def plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_url_rules(spark):
    cases = {
        "http://A.Com/x": ("a.com", "/x", "com/", "allow"),
        "https://example.com/en/1?q#f": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://blog.example.com/en/": ("blog.example.com", "/en/", "example.com/en/", "block"),
        "https://www.example.com/en/9": ("www.example.com", "/en/9", "www.example.com/en/", "allow"),
        "https://m.www.example.com/en/9": ("m.www.example.com", "/en/9", "www.example.com/en/", "allow"),
        "https://x.net/es/a": ("x.net", "/es/a", "net/es/", "block"),
        "https://x.net/es": ("x.net", "/es", None, "allow"),
        "https://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "https://a.com": ("a.com", "", None, "allow"),
        "https://a.com?x=/y": ("a.com", "", None, "allow"),
        "no scheme.com/x": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b.net/fr/x://c.com/": ("b.net", "/fr/x://c.com/", "net/fr/", "block"),
        "x://com./": ("com.", "/", None, "allow"),
    }
    rows = [*enumerate(cases), *enumerate(cases), (None, "http://b.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS rule", "2 AS bucket", "3 AS host", "4 AS times")
    out = urls.judged(df, urls.rule_table(spark, urls.RULES))
    got = out.collect()
    assert len(got) == len(rows)
    order = list(cases)
    for r in got:
        expected = ("b.com", "/", "com/", "allow") if r.page_id is None else cases[order[r.page_id]]
        assert (r.host, r.path, r.rule, r.verdict) == expected
    assert "Python" not in plans(out) and "Arrow" not in plans(out)
    assert urls.judged(df.limit(0), urls.rule_table(spark, urls.RULES)).count() == 0
    none = urls.judged(df, urls.rule_table(spark, []), otherwise="block")
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "block")}


def repeated(words):
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({i + k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(5)})


def test_quality_measures(spark, docs_of):
    draw = random.Random(2)
    texts = [None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 5000, "a\u00a0b c#$%\nq\nq\n\nq\n"]
    texts += [" ".join(draw.choice("abcd") for _ in range(draw.randint(0, 60))) for _ in range(60)]
    got = {r.doc_id: r for r in quality.verdicts(docs_of([*enumerate(texts), (3, "one")])).collect()}
    for i, text in enumerate(texts):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        lines = [x for x in (text or "").split("\n") if any(c not in " \t\n\v\f\r" for c in x)]
        r = got[i]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_host_verdicts(spark):
    clean = " ".join(f"w{k}" for k in range(40))
    junk = " ".join(f"w{k}###" for k in range(40))
    rows = [(i, junk if host == "bad" and i % 10 else clean, host) for i, host in enumerate(["bad", "good", "fine", None] * 50)]
    df = spark.createDataFrame([*rows, (999, junk, "good")], "doc_id long, text string, source string")
    out = quality.verdicts(df)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert all(kept[i] for i, text, _ in rows if text == clean)
    assert not any(kept[i] for i, text, _ in rows if text == junk) and kept[999]
    assert "Python" not in plans(out) and quality.verdicts(df.limit(0)).count() == 0


def targets(sizes, weights, share):
    """By repeated resharing, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = {s: left * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if level[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **level}
        for s in over:
            fixed[s] = 2 * sizes[s]
            left -= fixed[s]


def test_mix(spark):
    draw = random.Random(6)
    rows = []
    for i in range(3000):
        source = draw.choice(["a", "a", "a", "a", "b", "c", "d", "Z", None])
        rows.append((i, " ".join(["w"] * int(draw.paretovariate(1.1))) if i % 50 else None, source))
    rows += [(i, " \n", "empty") for i in range(4000, 4010)] + [rows[5], rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS rank", "3 AS block", "4 AS row", "5 AS k")
    out = mixing.mixed(df, docs_per_block=16)
    assert "Python" not in plans(out)
    got = out.select("doc_id", "source", "mix.*").collect()
    assert len(got) == len(rows)
    sizes, taken, aim = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        aim[r.source] = r.target
        assert r.taken == r.size * len(r.shards) and len(r.shards) <= 2 and all(0 <= s < 16 for s in r.shards)
    for source, target in targets(dict(sizes), mixing.WEIGHTS, 1.5).items():
        assert math.isclose(aim[source], target, abs_tol=1e-6)
        assert abs(taken[source] - target) <= max(2, 0.01 * target)
    again = mixing.mixed(df.repartition(5), docs_per_block=16).select("doc_id", "mix.taken").collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    drawn = mixing.taken_rows(df, docs_per_block=16)
    assert drawn.columns == df.columns and drawn.count() == sum(len(r.shards) for r in got)
    assert mixing.mixed(df.limit(0)).count() == 0


def test_shards_have_exact_quotas(spark):
    quotas = spark.createDataFrame([(1, 100), (2, 7), (3, 0), (4, 53)], "rank int, k long")
    for shards in (1, 5, 16):
        starts = {r.rank: r.starts for r in mixing.dealt(quotas, shards, 3).collect()}
        counts = np.array([np.diff([*starts[r], k]) for r, k in ((1, 100), (2, 7), (3, 0), (4, 53))])
        assert counts.shape == (4, shards) and (counts >= 0).all()
        assert set(counts.sum(axis=0)) <= {160 // shards, -(-160 // shards)} or counts.sum(axis=0).max() - counts.sum(axis=0).min() <= 2


def test_hypergeometric(spark):
    draws = spark.range(4000).select(mixing.hypergeometric(F.lit(30), F.lit(70), F.lit(20), (F.col("id") + 0.5) / 4000).alias("x"))
    found = collections.Counter(r.x for r in draws.collect())
    for x in range(0, 21):
        p = math.comb(30, x) * math.comb(70, 20 - x) / math.comb(100, 20)
        assert abs(found[x] / 4000 - p) < 0.001
    edges = spark.sql("SELECT 1").select(*(mixing.hypergeometric(*map(F.lit, c), F.lit(0.999)).alias(str(i)) for i, c in enumerate([(5, 0, 3), (0, 5, 3), (4, 4, 8), (3, 5, 0)]))).first()
    assert tuple(edges) == (3, 0, 4, 0)


def test_very_long_urls(spark):
    """Host and path of 100,000 characters each: as many expressions as the rules are deep."""
    import time

    rules = urls.rule_table(spark, [("a.example.com", "/x/y/", "block"), ("com", "/", "allow"), ("example.com", "/x/", "block")])
    long = "http://" + "l." * 50_000 + "a.example.com/x/y/" + "p/" * 50_000
    pages = spark.createDataFrame([(1, long), (2, "http://" + "h" * 100_000), (3, "http://example.com" + "/" * 100_000)], "page_id long, url string")
    urls.judged(pages.limit(0), rules).collect()
    start = time.time()
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judged(pages, rules).collect()}
    assert found == {1: ("a.example.com/x/y/", "block"), 2: (None, "allow"), 3: ("com/", "allow")}
    assert time.time() - start < 10


def test_hosts_clearly_worse_than_the_rest(spark):
    """A host with 35 % failures among hosts with 10 % is blocked, a small one with only failures is
    not; SQL agrees."""
    import duckdb

    clean = " ".join(f"w{i}" for i in range(20))
    rows, n = [], 0
    for host, docs, bad in [*((f"good{i}", 300, 30) for i in range(8)), ("bad", 300, 105), ("near", 300, 48), ("tiny", 2, 2), (None, 50, 5)]:
        for i in range(docs):
            rows.append((n := n + 1, clean + (" #########" if i < bad else ""), host))
    rows += [(0, None, "bad"), (-1, "short", "good1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.verdicts(df).collect()}
    by_host = {i: host for i, _, host in rows}
    lost = {i for i, r in got.items() if not r.kept and not r.base_failed}
    assert {by_host[i] for i in lost} == {"bad"} and len(lost) == 105
    assert all(got[i].kept for i, text, host in rows if text == clean)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    names = ["doc_id", "n_words", "n_symbols", "base_failed", "kept"]
    assert {tuple(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({quality.ORACLE})").fetchall()} == {tuple(r[c] for c in names) for r in got.values()}
