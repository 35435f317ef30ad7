"""Exact Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from playbill.llm import setjoin


def all_pairs(rows, words, num, den):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows, i = [], 0
    for family in range(8):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([5, 12, 40, 90, 150]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                copy = copy[draw.randint(0, 6) :]
            rows.append((i := i + 1, "  ".join(copy) + "\n"))
    return rows + [(900, None), (901, ""), (902, " \t"), (903, "One"), (904, "one "), (905, "one two"), (906, "x " * 3000)]


@pytest.mark.parametrize(("words", "num", "tile"), [(3, 90, 1 << 18), (5, 80, 1 << 18), (3, 70, 300), (3, 50, 300)])
def test_agrees_with_all_pairs(spark, docs_of, monkeypatch, words, num, tile):
    """Also with tiles so small that every family is cut into many."""
    monkeypatch.setattr(setjoin, "TILE_ITEMS", tile)
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.near_copies(docs_of(rows), words=words, num=num, den=100).collect()}
    assert got == all_pairs(rows, words, num, 100)


def test_odd_rows(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, text), (7, text), (5, text.upper()), (None, text), (9, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in setjoin.near_copies(docs_of(rows), words=3, num=90).collect())
    assert got == [(-1, 28, None), (5, 28, 5), (7, 28, 5), (7, 28, 5), (9, 0, 9)]
    assert setjoin.near_copies(docs_of(rows).limit(0)).count() == 0


def test_one_of_each_keeps_all_columns(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(7, text), (7, text), (5, text), (None, text), (9, None), (10, ""), (11, "other words here")]
    df = docs_of(rows)
    kept = setjoin.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 5, 9, 10, 11]


def test_parts_lose_no_pair():
    """Two sets that link have an equal part, whatever their sizes."""
    draw = np.random.default_rng(4)
    for _ in range(300):
        n = int(draw.integers(4, 400))
        a = np.unique(draw.integers(-(1 << 62), 1 << 62, n))
        b = a.copy()[int(len(a) * draw.random() * 0.12) :]
        b = np.unique(np.append(b, draw.integers(-(1 << 62), 1 << 62, int(len(a) * draw.random() * 0.1))))
        shared = len(np.intersect1d(a, b))
        for num in (80, 90):
            if len(a) != shared and 100 * shared >= num * (len(a) + len(b) - shared):
                assert {k for p in setjoin.part_keys(a, num, 100) for k in p.tolist()} & {k for p in setjoin.part_keys(b, num, 100) for k in p.tolist()}


@pytest.mark.parametrize("num", [90, 80, 70, 50])
def test_linking_sets_share_a_key(num):
    """Random pairs at and above the threshold, of all sizes, from one dealing to the last."""
    rng = np.random.default_rng(num)
    tried = 0
    while tried < 3000:
        size = int(rng.integers(1, 200))
        common = rng.integers(-(2**62), 2**62, size)
        extra = int(size * (100 - num) / num) + 1
        one, two = (np.concatenate([common, rng.integers(-(2**62), 2**62, int(rng.integers(0, extra + 1)))]) for _ in range(2))
        a, b = np.unique(one), np.unique(two)
        both = setjoin.overlaps(a, b)
        if np.array_equal(a, b) or 100 * both < num * (len(a) + len(b) - both):
            continue
        tried += 1
        keys = [set(np.concatenate([np.empty(0, np.int64), *setjoin.part_keys(x, num, 100)]).tolist()) for x in (a, b)]
        assert keys[0] & keys[1], (len(a), len(b), both)


def test_sets_apart_share_no_empty_part():
    """Sets of a band that have nothing in common hardly ever meet."""
    rng = np.random.default_rng(5)
    seen, met = {}, set()
    for i in range(400):
        items = np.unique(rng.integers(-(2**62), 2**62, int(rng.integers(100, 150))))
        for key in np.concatenate(setjoin.part_keys(items, 80, 100)).tolist():
            if key in seen and seen[key] != i:
                met.add((seen[key], i))
            seen.setdefault(key, i)
    assert len(met) < 100  # of 79,800 pairs


def test_bitmaps_of_a_tile_are_bounded(monkeypatch):
    """One long and many short sets, with few bits: the same links."""
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**62, 40))
    sets = [np.unique(rng.integers(0, 2**62, 5000))] + [np.unique(np.append(base[:-1], rng.integers(0, 2**62, 1))) for _ in range(60)]
    ids, sides = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    expected = setjoin.links_of_tile(ids, sides, sets, 80, 100)
    monkeypatch.setattr(setjoin, "TILE_BITS", 64)
    assert len(setjoin.links_of_tile(ids, sides, sets, 80, 100)) == len(expected) == 59


def test_texts_that_share_passages_with_neighbours_do_not_all_meet(spark, docs_of, monkeypatch):
    """A chain of 300 texts, each with most of the words of the next: candidates connect all, but
    what is compared grows with the number of texts."""
    seen, whole = [], setjoin.open_pairs

    def counted(tiles, *settings):
        seen.append(tiles.selectExpr("sum(size(members))").first()[0] or 0)
        return whole(tiles, *settings)

    monkeypatch.setattr(setjoin, "open_pairs", counted)
    monkeypatch.setattr(setjoin, "TILE_ITEMS", 300)
    rows = [(i, " ".join(f"w{k}" for k in range(20 * i, 20 * i + 100))) for i in range(300)]
    rows += [(1000 + i, " ".join(f"w{k}" for k in range(20 * i, 20 * i + 99))) for i in range(0, 300, 50)]
    got = {r.doc_id: r.component_id for r in setjoin.near_copies(docs_of(rows), words=5, num=80, den=100).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
    assert 0 < sum(seen) < 10 * len(rows)


def test_one_of_each_of_an_id_with_several_texts(spark, docs_of):
    """An id that is the smallest of one of its rows' groups stays, with all its rows."""
    one = " ".join(f"a{k}" for k in range(40))
    kept = setjoin.one_of_each(docs_of([(3, one), (5, one), (7, one), (7, None), (9, None), (9, None)]))
    assert sorted((r.doc_id, r.text or "") for r in kept.select("doc_id", "text").collect()) == [(3, one), (7, ""), (7, one), (9, "")]


def test_small_bitmaps_bound_from_above():
    """Bitmaps of different lengths, folded for every pair: no pair that links is left out."""
    rng = np.random.default_rng(7)
    base = np.unique(rng.integers(-(2**62), 2**62, 130))
    sets = [np.unique(np.append(base[: len(base) - cut], rng.integers(-(2**62), 2**62, more))) for cut, more in zip(rng.integers(0, 12, 40), rng.integers(0, 12, 40))]
    data = []
    for items in sets:
        bits = 1 << int(2 * len(items) - 1).bit_length()
        bitmap = np.zeros(bits // 8, np.uint8)
        where = (setjoin.mix(items.view(np.uint64)) % np.uint64(bits)).astype(np.int64)
        np.bitwise_or.at(bitmap, where >> 3, (1 << (where & 7)).astype(np.uint8))
        data.append(bitmap.tobytes())
    length = np.array(list(map(len, data))) // 8
    assert len(set(length.tolist())) > 1
    size = np.array(list(map(len, sets)))
    maps = {w: setjoin.folded(data, w, length) for w in set(length.tolist())}
    for a in range(40):
        for b in range(a):
            words = int(min(length[a], length[b]))
            spare = min(size[x] - int(np.bitwise_count(maps[words][x]).sum()) for x in (a, b))
            assert int(np.bitwise_count(maps[words][a] & maps[words][b]).sum()) + spare >= setjoin.overlaps(sets[a], sets[b])
