"""Toxicity: learns from document labels alone, finds the sentences, odd rows."""

import random

import pytest

from playbill.llm import toxicity

BAD = ["gruk", "vlem", "zorp"]


def document(seed, toxic):
    draw = random.Random(seed)
    parts = [[f"w{int(draw.paretovariate(0.5)) % 3000}" for _ in range(draw.randint(4, 14))] for _ in range(draw.randint(3, 30))]
    place = draw.randrange(len(parts))
    if toxic:
        parts[place].insert(1, draw.choice(BAD).capitalize())
    return ". ".join(" ".join(p) for p in parts) + ".", place


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, document(i, i % 6 == 0)[0]) for i in range(900)]
    docs = spark.createDataFrame([*rows, (None, "x"), (2000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(i % 6 == 0)) for i, _ in rows), (1, None), (2000, 1), (None, 1), (3000, 1)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def test_held_out(model):
    hits = [model.score(document(i, i % 2 == 0)[0])[0] >= 0.5 for i in range(5000, 5200)]
    assert sum(hit == (i % 2 == 0) for i, hit in enumerate(hits)) >= 196


def test_locates_the_sentence(spark, docs_of, model):
    made = {i: document(i, True) for i in range(6000, 6030)}
    found = toxicity.offending_sentences(docs_of([(i, t) for i, (t, _) in made.items()]), model).collect()
    right = {r.doc_id for r in found if r.place == made[r.doc_id][1] and any(b in r.sentence.lower() for b in BAD)}
    assert len(right) >= 29


def test_rows(spark, docs_of, model):
    df = docs_of([(1, None), (2, ""), (3, "?!"), (4, "gruk"), (4, "gruk"), (None, "gruk"), (5, "fine words. " * 20_000)])
    got = toxicity.scored(df, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert [r.predicted for r in got[:6]] == [0, 0, 0, 1, 1, 1]
    assert toxicity.scored(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(df, labels).score("gruk")[0] < 0.5


def test_sentence_texts_agree_with_sentences():
    text = "One. Two!\n\nThree ünd four?"
    assert toxicity.sentence_texts(text) == ["One", "Two", "", "", "Three ünd four", ""]
    assert [bool(p) for p in toxicity.sentences(text)] == [True, True, False, False, True, False]
