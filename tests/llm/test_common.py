"""Components against union-find, and the other helpers."""

import random

import pytest

from playbill.llm import common


def components(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none", "loops"])
def test_connected(spark, kind):
    draw = random.Random(5)
    pairs = {
        "path": [(i, i + 1) for i in draw.sample(range(40), 38)],
        "star": [(7, i) for i in range(30)],
        "random": [(draw.randrange(80), draw.randrange(80)) for _ in range(60)],
        "none": [],
        "loops": [(3, 3), (5, 4), (4, 5), (5, 4)],
    }[kind]
    got = {r.node: r.component for r in common.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == components([(a, b) for a, b in pairs if a != b])


def test_slices():
    assert list(common.slices([1, 2, 50, 1, 1, 1], 3, 10)) == [(0, 2), (2, 1), (3, 3)]
    assert list(common.slices([], 3, 10)) == []


def test_join_bounded_is_the_same_either_way(spark, monkeypatch):
    big, small = spark.range(50).selectExpr("id AS k", "id * 2 AS v"), spark.range(10).selectExpr("id * 3 AS k")
    expected = sorted(map(tuple, common.join_bounded(big, small, ["k"], "left_semi", 8).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, common.join_bounded(big, small, ["k"], "left_semi", 8).collect())) == expected and expected


def test_shingles():
    words = common.lower_words("A b C  a b C a".encode())
    assert words == [b"a", "b c".encode(), b"a", "b c".encode(), b"a"]
    assert len(common.shingles(words, 3)) == 2 and len(common.shingles(words[:2], 3)) == 1 and len(common.shingles([], 3)) == 0
    assert common.lower_words(None) == []


def test_workers_get_small_batches(spark):
    """Long texts go to a Python worker a few megabytes at a time, unless the session has its own limit."""
    name, default = common.BATCH_CONF, f"{common.BATCH_DEFAULT}b"
    before = spark.conf.get(name)
    try:
        for own, expected in ((default, common.BATCH_BYTES), ("9000000b", 9_000_000)):
            spark.conf.set(name, own)
            common.ship(spark)
            assert int(spark.conf.get(name).strip("b")) == expected
    finally:
        spark.conf.set(name, before)


def test_join_lists_counts_what_lists_take(spark, monkeypatch):
    """Many rows with short lists are broadcast, few with long ones are not; the rows are the same."""
    big = spark.range(400).selectExpr("id AS k", "id * 2 AS v")
    short = spark.range(300).selectExpr("id AS k", "if(id % 7 = 0, NULL, array(id)) AS some")
    long = spark.range(300).selectExpr("id AS k", "if(id = 3, sequence(1, 9000), array()) AS some")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 40_000)
    for small, fits in ((short, True), (long, False)):
        joined = common.join_lists(big, small, ["k"], "left", {"some": 8})
        assert ("ResolvedHint (strategy=broadcast)" in joined._jdf.queryExecution().analyzed().toString()) == fits
        assert sorted(r.k for r in joined.collect()) == list(range(400))


def test_among_leaves_rows_where_they_are(spark, monkeypatch):
    """Most keys stay: the few that go are broadcast, and the rows are not shuffled."""
    big = spark.range(300).selectExpr("id % 100 AS k", "id AS v")
    keys, others = spark.range(5, 100).selectExpr("id AS k"), spark.range(5).selectExpr("id AS k")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 16 * 20)
    found = common.among(big, ["k"], keys, others)
    assert "ResolvedHint (strategy=broadcast)" in found._jdf.queryExecution().analyzed().toString()
    assert sorted(r.v for r in found.collect()) == [v for v in range(300) if v % 100 >= 5]
    assert sorted(r.v for r in common.among(big, ["k"], others, keys).collect()) == [v for v in range(300) if v % 100 < 5]
