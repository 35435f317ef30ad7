"""Token alignment against brute force: whole texts, plain sets of byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import accumulate
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from playbill.llm import alignment as L

BYTE_LEVEL, PIECES = (Path(public_tokenizers.path(name)).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
KIND = "doc_id long, text string"


@pytest.fixture(scope="module")
def own():
    return L.Tokenizers(BYTE_LEVEL, PIECES)


def brute_force(own, texts):
    """A row for each text."""
    found, links = [], []
    for text in texts:
        data = b" " + (text or "").encode()
        a, b = own.a.encode(" " + (text or ""), add_special_tokens=False).ids, own.b.encode(text or "")
        if not text or b"".join(own.bytes_a[i] for i in a) != data or b"".join(own.bytes_b[i] for i in b) != data:
            found.append(None)
            links.append(Counter())
            continue
        ends_a, ends_b = (list(accumulate(len(names[i]) for i in ids)) for ids, names in ((a, own.bytes_a), (b, own.bytes_b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:u], b[j:v]))
            i, j = u, v
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((len(a), len(b), len(groups), hashlib.sha256(said.encode()).hexdigest()))
        links.append(Counter((x, y) for some, others in groups for x in some for y in others))
    counts, best = Counter(p for some in links for p in some), defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    rows = []
    for f, some in zip(found, links):
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            on_top = sum(n for p, n in some.items() if counts[p] == best[p[0]])
            rows.append((*f[:3], sum(some.values()), on_top, sum(n * counts[p] for p, n in some.items()), f[3]))
    return rows


def result(df, **settings):
    rows = L.aligned(df, BYTE_LEVEL, PIECES, **settings).collect()
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows)


def odd_texts(seed, n):
    rng = random.Random(seed)
    bits = ["the", " ", "  ", "\n", "\t", " \n ", "don't", "'s", "é", "漢字", "😀👍🏽", " ", "　", " ", "1234", "...", "<|endoftext|>", "</s>", "<unk>", "<0x41>",
            "é", "​", "Ĝ", "Ġ", "ﬁ", "²", "\x00", "\x1c", "\x85", "antidisestablishment", "x" * 30, "ab.cd", "'", "\"", "ß", "᠎", "﻿"]
    return ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(n)]


def test_against_brute_force(spark, own):
    texts = [None, "", " ", "  ", "▁", "a▁b", " a", "a ", *odd_texts(1, 600)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS row", "'x' AS no", "2 AS pairs", "3 AS n", "4 AS part", "5 AS docs")
    expected = sorted((str(i), *row) for i, row in enumerate(brute_force(own, texts)))
    assert result(df) == expected
    assert result(df, segment=12) == expected  # most texts in segments, by a tree of several levels


def test_repeated_and_missing_ids(spark, own):
    texts = ["some words here", "some words here", None, "other words", "a long " * 40]
    ids = [7, 7, None, None, 7]
    expected = sorted((str(i), *row) for i, row in zip(ids, brute_force(own, texts)))
    for segment in (1 << 16, 30):
        assert result(spark.createDataFrame(list(zip(ids, texts)), KIND), segment=segment) == expected
    assert result(spark.createDataFrame([], KIND)) == []


def test_long_texts(spark, own):
    """A document of many segments, one without a place to cut, and one spoilt in its last segment."""
    rng = random.Random(5)
    words = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(60_000))
    texts = [words, "".join(rng.choices("漢字かな🙂é", k=70_000)), words[:100_000] + " ▁"]
    expected = sorted((str(i), *row) for i, row in enumerate(brute_force(own, texts)))
    assert result(spark.createDataFrame(list(enumerate(texts)), KIND), segment=4000) == expected
    assert expected[2][1] == 0 < expected[0][1]


def test_fragments_compose(own):
    """Any way of bracketing the ranges of a text gives the fragment of the whole; ends stay open."""
    rng = random.Random(6)
    for text in odd_texts(2, 60):
        a, b, same = own.encoded([text])
        a, b = (np.array(x[0], np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(own.sizes_a[a]), np.cumsum(own.sizes_b[b])
        if not same[0]:
            continue
        whole = L.Fragment.of_range(a, ends_a, b, ends_b)
        parts, at = [], 0
        while at < ends_a[-1]:
            to = at + rng.randrange(1, 9)
            u, v = (ends_a > at) & (ends_a <= to), (ends_b > at) & (ends_b <= to)
            parts.append(L.Fragment.of_range(a[u], ends_a[u], b[v], ends_b[v]))
            at = to
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        for one in (parts[0], L.Fragment.of(a, ends_a, b, ends_b, size=5)):
            assert all(np.array_equal(getattr(one, c), getattr(whole, c)) for c in ("a", "b", "cuts_a", "cuts_b"))


def test_large_group_in_blocks():
    """Pairs of a group of 300 x 200 tokens, expanded 1,000 at a time."""
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 40, 300), rng.integers(0, 30, 200)
    f = L.Fragment(a, b, np.array([300]), np.array([200]))
    found = Counter()
    for owner, x, y, n in L.linked_pairs(f, np.array([3]), block=1000):
        assert set(owner) == {3} and not found.keys() & set(zip(x.tolist(), y.tolist()))
        found.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert found == Counter((x, y) for x in a.tolist() for y in b.tolist())


def test_kept_units_are_dropped_when_full(own, monkeypatch):
    monkeypatch.setattr(L, "UNITS", 50)
    units, fresh = L.Units(own), L.Units(own)
    for text in odd_texts(3, 200):
        if len(units.number) > 50:
            fresh = L.Units(own)
        (numbers,) = units.numbers([text])
        assert [x[2:7] for x in units.lines(1, 1, numbers)] == [x[2:7] for x in fresh.lines(1, 1, fresh.numbers([text])[0])]
        assert len(units.number) <= 50 + 60
