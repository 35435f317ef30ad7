"""Language identification: held-out accuracy, rejection, odd rows."""

import random

import pytest

from playbill.llm import langid

SYLLABLES = {"aa": "ba be bi bo da de", "bb": "ka ke ki ko sha sho", "cc": "lü lä lö mü mä nö"}


def prose(language, n, seed):
    draw = random.Random(f"{language}{seed}")
    parts = SYLLABLES[language].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    made = [(i, prose(lang, 3 + i % 60, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    return [*made, (900, "no label", None), (901, None, "aa"), (902, "123 ###", "aa"), (None, prose("aa", 5, 1), "aa")]


@pytest.fixture(scope="module")
def model(spark, rows):
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=40, clusters=3)


def test_held_out_accuracy(model):
    assert model.languages == sorted(SYLLABLES) and len(model.owner) == 9
    texts = [(lang, prose(lang, 12, f"new{k}")) for lang in SYLLABLES for k in range(40)]
    names, scores, rejected = model.predict([t for _, t in texts])
    assert sum(a == b for (a, _), b in zip(texts, names, strict=True)) >= 118
    assert all(0 <= s <= 1 for s in scores) and not any(rejected)


def test_rejects_by_distance(model):
    junk = "".join(random.Random(1).choice("qxzvwjyf") for _ in range(300))
    names, scores, rejected = model.predict([junk, prose("bb", 50, "x"), None, "", "12 ##"])
    assert rejected == [True, False, True, True, True]
    assert names[2:] == ["und"] * 3 and scores[2:] == [0.0] * 3 and names[0] in SYLLABLES


def test_rows(spark, docs_of, model):
    df = docs_of([(1, None), (2, ""), (3, prose("cc", 30, 0)), (3, prose("cc", 30, 0)), (None, prose("aa", 30, 0)), (4, prose("bb", 40_000, 0))])
    got = sorted((r.doc_id or -1, r.lang_pred) for r in langid.identified(df, model).collect())
    assert got == [(-1, "aa"), (1, "und"), (2, "und"), (3, "cc"), (3, "cc"), (4, "bb")]
    kept = langid.accepted(df, model)
    assert kept.columns == df.columns and kept.count() == 4
    assert langid.identified(df.limit(0), model).count() == 0


def test_fit_is_the_same_again_and_works_without_rows(spark, rows, model):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    again = langid.fit(df, per_language=40, clusters=3)
    assert (again.centroids == model.centroids).all() and (again.floor == model.floor).all()
    empty = langid.fit(df.limit(0))
    assert empty.predict(["text"]) == (["und"], [0.0], [True])
