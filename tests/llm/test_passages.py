"""Repeated passages against a brute-force search."""

import random

from playbill.llm import passages

DRAW = random.Random(11)


def prose(n):
    return [f"v{DRAW.randrange(10**6)}" for _ in range(n)]


def text_of(words):
    return " ".join(w + ("\n" if k % 17 == 16 else "") for k, w in enumerate(words))


def test_planted_passages(spark, docs_of):
    """Copied into the middle of other lines, over line ends, near copies of lines; the rest stays."""
    shared = [prose(n) for n in (51, 60, 120)]
    line = prose(80)
    close = list(line)
    close[3] = "changed"
    short = prose(25)
    plain = {i: prose(200) for i in range(10, 30)}
    planted = {i: plain[i][:50] + shared[i % 3] + plain[i][50:] for i in range(10, 16)}
    texts = {i: text_of(planted.get(i, w)) for i, w in plain.items()}
    texts[20] += "\n" + " ".join(line) + "\n"
    texts[21] += "\n" + " ".join(close) + "\n"
    texts[22] = " ".join([*plain[22], *short])
    texts[23] = " ".join([*plain[23], *short])
    df = docs_of(list(texts.items()))
    rows = passages.removals(df).collect()
    assert {r.doc_id for r in rows} == {13, 14, 15, 21}
    assert {(r.doc_id, r.kept_doc_id) for r in rows} == {(13, 10), (14, 11), (15, 12), (21, 20)}
    for r in rows:
        if r.doc_id < 20:
            n = len(shared[r.doc_id % 3])
            assert 50 <= r.start_word <= 65 and 50 + n - 15 <= r.end_word <= 50 + n
    out = {r.doc_id: r for r in passages.without_repeats(df, length_column="n_chars").collect()}
    assert len(out) == len(texts) and all(r.n_chars == len(r.text) for r in out.values())
    assert all(out[i].text == texts[i] for i in texts if i not in (13, 14, 15, 21))
    assert out[21].text == texts[21].replace(" ".join(close) + "\n", "")
    words = {i: r.text.split() for i, r in out.items()}
    for r in rows:
        if r.doc_id < 20:
            source = planted[r.doc_id]
            assert words[r.doc_id] == source[: r.start_word] + source[r.end_word :]


def test_finds_every_shared_run(spark, docs_of):
    pool = prose(400)
    rows = []
    for i in range(30):
        words = []
        while len(words) < 150:
            words += prose(DRAW.randrange(20)) + pool[(a := DRAW.randrange(350)) : a + DRAW.randrange(70)]
        rows.append((i, text_of(words)))
    covered = {}
    for r in passages.removals(docs_of(rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    first, size = {}, 48
    words = {i: t.split() for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - size + 1):
            owner = first.setdefault(tuple(w[k : k + size]), i)
            assert owner == i or covered.get(i, set()) >= set(range(k, k + size))


def test_odd_rows(spark, docs_of):
    text = " ".join(prose(100))
    rows = [(4, text), (4, text), (None, text), (6, None), (7, ""), (8, "short"), (9, text.upper())]
    df = docs_of(rows)
    assert {(r.doc_id, r.kept_doc_id, r.start_word, r.end_word) for r in passages.removals(df).collect()} == {(9, 4, 0, 100)}
    out = passages.without_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert {r.doc_id: r.text for r in out.collect()}[9] == ""
    assert passages.removals(df.limit(0)).count() == 0 == passages.without_repeats(df.limit(0)).count()


def test_tuned_bands():
    b = passages.tuned_bands(0.8, 0.995)
    assert 1 - (1 - 0.8**3) ** b >= 0.995 > 1 - (1 - 0.8**3) ** (b - 1)


def test_short_lines_and_paragraphs_of_them(spark, docs_of):
    """Against brute force over all lines and blank-line paragraphs, all shorter than a window."""

    def shingles(words):
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    def near(a, b):
        a, b = shingles(a), shingles(b)
        return bool(a) and len(a & b) >= 0.8 * len(a | b)

    lines = [prose(n) for n in (5, 9, 20, 28, 31)]
    block = [prose(9) for _ in range(9)]
    changed = [list(x) for x in block]
    changed[4][4] = "changed"
    texts = {}
    for i in range(12):
        own = [prose(DRAW.randrange(1, 31)) for _ in range(6)]
        for line in DRAW.sample(lines, 2):
            copy = list(line)
            if i % 2:
                copy[-1] = f"end{i}"
            own[DRAW.randrange(6)] = copy
        texts[i] = [[x] for x in own]
    texts[20] = [[prose(7)], block, [prose(6)]]
    texts[21] = [[prose(8)], changed, [prose(7)]]
    flow = sum(block, [])
    texts[22] = [[flow[k : k + 13] for k in range(0, len(flow), 13)]]  # other line borders
    df = docs_of([(i, "\n\n".join("\n".join(map(" ".join, x)) for x in t)) for i, t in texts.items()])
    lost = {i: set() for i in texts}
    for r in passages.removals(df).collect():
        lost[r.doc_id] |= set(range(r.start_word, r.end_word))
    units = []
    for i, paragraphs in texts.items():
        at = 0
        for paragraph in paragraphs:
            units.append((i, at, sum(paragraph, [])))
            for line in paragraph:
                units.append((i, at, line))
                at += len(line)
    expected = {i: set() for i in texts}
    for i, at, words in units:
        if len(words) >= 5 and any(j < i and near(words, other) for j, _, other in units):
            expected[i] |= set(range(at, at + len(words)))
    assert sum(map(len, expected.values())) > 200
    assert lost == expected


def test_runs_in_full_length(spark, docs_of):
    """Every word of every shared run of 48 words or more goes, the borders exactly; the first
    document with a part of a run need not be the one that shares most of it."""
    pool = [prose(90) for _ in range(6)]
    rows = []
    for i in range(40):
        run = pool[i % 6]
        a, b = DRAW.randrange(0, 21), DRAW.randrange(70, 91)
        rows.append((i, " ".join([*prose(DRAW.randrange(40, 60)), *run[a:b], *prose(40), *run[5:53], *prose(9)])))
    lost = {i: set() for i, _ in rows}
    for r in passages.removals(docs_of(rows)).collect():
        lost[r.doc_id] |= set(range(r.start_word, r.end_word))

    def shared(size):
        earlier, found = set(), {}
        for i, text in rows:
            words = text.split()
            places = {k: tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
            found[i] = {k + x for k, w in places.items() if w in earlier for x in range(size)}
            earlier |= set(places.values())
        return found

    always, at_most = shared(48), shared(32)
    assert sum(map(len, always.values())) > 2000
    assert all(always[i] <= lost[i] <= at_most[i] for i in lost)


def test_sections_in_several_documents_meet_in_one_shuffle(spark):
    """Also where a group goes on over many batches; the smallest id and all places are found."""
    rows = [(k % 2, DRAW.randrange(40), DRAW.randrange(2), DRAW.randrange(25), 0, k, k + 32) for k in range(400)]
    rows += [(0, 99, 0, 50 + k % 30, 0, k, k + 32) for k in range(90)] + [(0, 98, 0, 7, 0, k, k + 32) for k in range(20)]
    df = spark.createDataFrame(rows, "kind int, key long, check int, doc_id long, version long, start int, end int")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        found = passages.in_several(df)
        assert found._jdf.queryExecution().sparkPlan().toString().count("RepartitionByExpression") + found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        got = [(*r,) for r in found.collect()]
    finally:
        spark.conf.set(name, before)
    docs = {}
    for r in rows:
        docs.setdefault(r[:3], set()).add(r[3])
    several = sorted((*r, min(docs[r[:3]])) for r in rows if len(docs[r[:3]]) > 1)
    assert sorted(r for r in got if len(docs[r[:3]]) > 1) == several
    assert all(r[7] == r[3] for r in got if len(docs[r[:3]]) == 1)
