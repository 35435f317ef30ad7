"""The registered queries and the pipeline over the smallest tables, against SQL or brute force."""

import hashlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from playbill.llm import alignment, bpe, queries
from tests.llm.test_alignment import BYTE_LEVEL, PIECES, brute_force
from tests.llm.test_setjoin import all_pairs

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def texts(sql):
    return dict(sql.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.read_ranks(Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def order(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_agrees_with_sql(spark, sql, name):
    df = queries.QUERIES[name](spark, str(FOLDER))
    found = sql.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    places = [columns.index(c) for c in df.columns]
    expected = sorted((tuple(row[i] for i in places) for row in found.fetchall()), key=order)
    assert sorted(map(tuple, df.collect()), key=order) == expected and expected


def test_op1(spark, sql):
    lang = dict(sql.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = queries.op1_language_id(spark, str(FOLDER)).collect()
    held_out = [r for r in got if r.held_out]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held_out) >= 0.95 * len(held_out)


def test_op2(spark):
    got = queries.op2_main_text(spark, str(FOLDER)).collect()
    assert got and all(r.n_chars == len(r.text) > 0 and "track(" not in r.text and "<" not in r.text[:5] for r in got)


def test_op3(spark, texts, encoding):
    got = queries.op3_bpe_codec(spark, str(FOLDER)).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op4(spark, texts):
    got = queries.op4_toxicity(spark, str(FOLDER)).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_op6(spark, texts):
    got = queries.op6_source_mix(spark, str(FOLDER)).collect()
    assert len(got) == len(texts) and all(r.size == len(texts[r.doc_id].encode().split()) for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * sum(r.size for r in got)) <= 0.02 * sum(r.size for r in got)


def test_op7(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_ngram_jaccard_join(spark, str(FOLDER)).collect()}
    assert got == all_pairs(list(texts.items()), 3, 90, 100)


def test_op10(spark, texts):
    words = {i: t.encode().lower().split() for i, t in sorted(texts.items())}
    covered = {}
    for r in queries.op10_passage_dedup(spark, str(FOLDER)).collect():
        assert r.kept_doc_id < r.doc_id and 0 <= r.start_word < r.end_word <= len(words[r.doc_id])
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    first = {}
    for i, w in words.items():
        for k in range(len(w) - 47):
            if first.setdefault(tuple(w[k : k + 48]), i) != i:
                assert covered.get(i, set()) >= set(range(k, k + 48))


def test_op12(spark, texts):
    """Every row against whole texts aligned by plain sets of offsets."""
    expected = dict(zip(texts, brute_force(alignment.Tokenizers(BYTE_LEVEL, PIECES), texts.values())))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r[c] for c in names) for r in queries.op12_token_alignment(spark, str(FOLDER)).collect()} == expected


def test_pipeline(spark, texts, encoding, tmp_path):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    kept = {}
    for step, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(FOLDER)).write.parquet(path := str(tmp_path / str(step)))
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        assert docs.columns == names or step == len(corpus_pipeline.STAGES) - 1
    language, near, cut, mix, tokens = kept.values()
    rejected = {r.doc_id for r in queries.op1_language_id(spark, str(FOLDER)).collect() if r.rejected}
    assert {r.doc_id for r in language} == set(texts) - rejected
    # what is far from every language is one word again and again
    assert all(len(set(texts[i].split())) <= 0.2 * len(texts[i].split()) for i in rejected if any(c.isalpha() for c in texts[i]))
    groups = all_pairs([(r.doc_id, r.text) for r in language], 5, 80, 100)
    assert sorted(r.doc_id for r in near) == sorted(i for i, (_, root) in groups.items() if i == root)
    assert sorted(r.doc_id for r in cut) == sorted(r.doc_id for r in near) and all(r.n_chars == len(r.text) for r in cut)
    runs = {}
    for r in cut:
        w = r.text.encode().lower().split()
        for k in range(len(w) - 50):
            assert runs.setdefault(tuple(w[k : k + 51]), r.doc_id) == r.doc_id
    by_id = {r.doc_id: r for r in cut}
    assert all(r == by_id[r.doc_id] for r in mix)
    size = {r.doc_id: len(r.text.split()) for r in cut}
    assert abs(sum(size[r.doc_id] for r in mix) - 1.5 * sum(size.values())) <= 0.02 * sum(size.values())
    assert sorted(r.doc_id for r in tokens) == sorted(r.doc_id for r in mix)
    assert all(r.ids == encoding.encode_ordinary(by_id[r.doc_id].text) and r.round_trip for r in tokens)
