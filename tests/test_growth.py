"""Steps whose cost has to grow no faster than their input."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from playbill.functions import dates as D
from playbill.functions import html as H
from playbill.functions import text as X
from playbill.operators import fields, rule_tables
from playbill.plans import rendering as W, rules as R, venues
from playbill.schema import PAGES
from playbill.session import JOB_CONF, with_method_limit
from playbill.sources import pages as P
from playbill.sources import folders
from playbill.sources import store as S
from playbill.streaming import ingest


def test_partitions_grow_with_the_rows(spark):
    """The same rows a task, however large the table; a small one keeps the number asked for."""
    assert P.spread(spark.range(1000), 3, 100).rdd.getNumPartitions() == 10
    assert P.spread(spark.range(1000), 3, 500).rdd.getNumPartitions() == 3
    assert P.spread(spark.range(0), 3, 500).rdd.getNumPartitions() == 3
    assert P.spread(spark.range(1000), 3).rdd.getNumPartitions() == 3


def test_method_limit_is_set_where_the_session_has_sparks_own(spark):
    name, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set(name, "65535")
        assert with_method_limit(spark).conf.get(name) == JOB_CONF[name]
        spark.conf.set(name, "4000")
        assert with_method_limit(spark).conf.get(name) == "4000"
    finally:
        spark.conf.set(name, before)


def test_a_date_is_parsed_by_one_expression(spark):
    """One look and one parser for all forms: a projection with one for each became too large to compile."""
    texts = ["5 Jun 2020", "5 june 2020", "5/6/2020", "05.6.2020", "2020-6-5", "2020.06.05", "2020年 6月5日", "5 Sept 2020", "31 Jun 2020", "5/6.2020"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").withColumn("date", D.parse_date(F.col("text")))
    assert [row.date for row in rows.collect()] == [datetime.date(2020, 6, 5)] * 7 + [None] * 3
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 1


def test_squeezed_text(spark):
    text = " a  b\t c d　e\n"
    assert spark.createDataFrame([(text,)], "t string").select(X.squeeze(F.col("t"))).first()[0] == "a b c d e"


def test_many_like_keywords_meet_few_titles(spark):
    """Keywords that differ in some digits only: a title is compared with a few of them, not with all
    that share three characters."""
    count = 3000
    rules = spark.range(count).selectExpr("id AS rule_no", "'t' AS type_eng", "'c' AS type_chi", "concat('customer#', lpad(id, 9, '0')) AS keyword")
    titles = spark.range(count).selectExpr("concat('For Customer#', lpad(id, 9, '0'), ' Aa') AS title")
    longest = spark.createDataFrame([(count, "s", "s", "aa")], rules.schema)
    size = F.when(F.length("keyword") >= rule_tables.LONG_GRAM, rule_tables.LONG_GRAM).otherwise(rule_tables.GRAM)
    grams = rules.select("keyword", F.explode(F.array_distinct(rule_tables._grams(F.col("keyword"), size))).alias("gram"))
    rarest = grams.join(grams.groupBy("gram").count(), "gram").groupBy("keyword").agg(F.min("count").alias("n"))
    assert rarest.agg(F.max("n")).first()[0] <= 11
    found = rule_tables.classify_by_table(titles, rules)
    assert found.count() == count
    both = rule_tables.classify_by_table(titles, rules.unionByName(longest))
    assert {row.type_eng for row in both.collect()} == {"s"}


def test_few_labels_keep_the_tokens_out_of_a_shuffle(spark):
    rows = spark.createDataFrame([(1, "x", ["Date", "May", "date", "June"]), (2, "x", ["Fee"])], "id int, source string, tokens array<string>")
    rules = spark.createDataFrame([("x", "when", "date", 1), ("x", "fee", "fee", 1)], "source string, field string, alias string, rank int")
    told = rule_tables.labels_by_table(rows, rules, ("id",))
    assert "BroadcastHashJoin" in told._jdf.queryExecution().sparkPlan().toString()
    assert [tuple(row) for row in told.collect()] == [(1, "when", "May")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_pattern_runs_once_a_row(spark):
    """An empty match becomes NULL without a second look, within a condition and a chain too."""
    rows = spark.createDataFrame([("<i>a</i>", "s", "en"), ("<i></i>", "s", "en"), ("", "s", "zh"), (None, "s", "en")], "html string, source string, lang string")
    rules = [fields.FieldRule("s", "en", "name", 1, "<i>([^<]*)</i>", "b"), fields.FieldRule("s", "en", "name", 2, "<u>([^<]*)</u>")]
    found = fields.extract_fields(rows, rules)
    assert [row.name for row in found.collect()] == ["a", None, None, None]
    assert [_plan(found).count(f"<[{tag}]>([^<]*)") for tag in ("iI", "uU")] == [1, 1]
    named = rows.select(X.once(H.first_group(F.col("html"), "<i>([^<]*)</i>"), X.unescape).alias("name"))
    assert _plan(named).count("([^<]*)") == 1
    assert [row.name for row in named.collect()] == ["a", None, None, None]


def test_entries_without_a_key_are_found_by_their_page(spark):
    """Whether an entry has a key is read off its page; the pattern of its id runs for the key alone."""
    orders = spark.createDataFrame([(7, 1, "1995-03-05", "3-M", "P", 5.0)], "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string, o_orderstatus string, o_totalprice double")
    halves = venues.page_halves(W.asia_world_expo(W.show_rows(orders)), W.AS_OF, [R.ASIA_WORLD_EXPO])
    assert halves.count() == 6
    filters = [line for line in _plan(halves).split("\n") if "Filter" in line and "[^\"]+\\d{4}" in line]
    assert all("isnotnull(page_id" in line or "isnotnull(page#" in line for line in filters)
    assert _plan(halves).count("[^\"]+\\d{4}") <= 2


def test_a_word_border_is_looked_for_behind_the_letter(spark):
    texts = ['<a class="b">', '<a data-class="b">', '<a xclass="b">', '<a éclass="b">', '<a _class="b">', "<a CLASS='b'>", 'class=b>', '<a cclass="b">']
    pattern = H.tolerant(r'\bclass="b"')[0]
    assert not pattern.startswith(r"\b")
    plain = r"""\b[cC][lL][aA][sS][sS]\s*=\s*(?:"b"|'b'|b(?=[\s>]))"""
    rows = spark.createDataFrame([(text,) for text in texts], "t string").select(F.col("t").rlike(pattern).alias("new"), F.col("t").rlike(plain).alias("old"))
    assert [row.new for row in rows.collect()] == [row.old for row in rows.collect()] == [True, True, False, False, False, True, True, False]


def test_written_tables_are_zstd(spark, tmp_path):
    """pages, the store and its ids take the smaller codec."""
    row = "1L AS page_id, 'a' AS source, 'detail' AS page_kind, 'en' AS lang, 'u' AS url, '<p>' AS html, current_timestamp() AS fetched_at"
    P.store_pages(spark.sql(f"SELECT {row}"), f"{tmp_path}/pages")
    S.append_new(spark.sql("SELECT 'i' AS event_id, 'a' AS source, current_timestamp() AS fetch_date"), f"{tmp_path}/store")
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) == 3 and all(".zstd." in file.name for file in files)


def test_element_bodies_hold_one_number(spark):
    """F8: depth and length of an element are one number, and the regions are those of nested tags."""
    html = '<div class="a">x<div>é<div/><DIV>y</DIV></div></div>z</div><div class="a">t</div><div class="a">open <div>w</div>'
    found = spark.createDataFrame([(html,), ("",), (None,)], "html string").coalesce(1)
    found = found.select(H.element_bodies(F.col("html"), r'<div[^>]*\bclass="a"[^>]*>').alias("b"))
    assert found.collect()[0].b == ["x<div>é<div/><DIV>y</DIV></div></div>z", "t", "open <div>w</div>"]
    assert [row.b for row in found.collect()[1:]] == [[], None]
    assert "named_struct" not in found._jdf.queryExecution().analyzed().toString()


def test_leaves_are_cut_without_a_pattern(spark):
    """the end of a division is found as text, once."""
    pages = spark.createDataFrame([], PAGES)
    plan = venues.museum_of_art(pages, W.AS_OF)._jdf.queryExecution().analyzed().toString()
    assert ", </div>, 2)" not in plan


def test_text_nodes_are_cleaned_once(spark):
    """what a text node becomes, and that no tags are looked for in it again."""
    text = "a &lt;b&gt;<p> c\r\n&nbsp;d\t</p>&amp; <i></i>  &nb\nsp;"
    found = spark.createDataFrame([(text,), (None,)], "t string").select(X.joined_nodes(F.col("t")).alias("t"))
    assert [row.t for row in found.collect()] == ["a <b>c  d&&nbsp;", None]
    assert "</?[^>]*>" not in found._jdf.queryExecution().analyzed().toString()


def test_event_ids_stay_out_of_the_shuffle(spark, tmp_path):
    """condensing half records moves their keys; the hashed ids are made again, and are the same."""
    kept = ingest.Kept(spark, str(tmp_path)).halves.schema
    row = {field.name: None for field in kept} | {"source": "a", "lang": "en", "page_id": 1, "pos": 0, "link_key": "k", "hop": 0}
    halves = ingest.with_event_id(spark.createDataFrame([row, row | {"source": R.ASIA_WORLD_EXPO}], kept).drop("run"))
    found = ingest.condensed(halves)
    assert sorted(found.collect()) == sorted(halves.collect()) and found.columns == halves.columns
    exchanges = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line]
    assert len(exchanges) == 1 and "event_id" not in exchanges[0]


def test_keys_in_fewer_bytes(spark):
    """hashes are half as long in a shuffle, and any key comes back."""
    keys = ["0123456789abcdef" * 4, "0123456789ABCDEF" * 4, "0" * 64, "0" * 63, "f" * 64 + "\n", "é" * 64, "", "show-1-2-2020", "x" * 31, None]
    found = spark.createDataFrame([(key,) for key in keys], "k string").withColumn("s", folders.short("k")).withColumn("back", folders.spelt("s")).collect()
    assert [row.back for row in found] == keys
    assert len({bytes(row.s) for row in found if row.s is not None}) == len(keys) - 1
    assert [len(row.s) for row in found[:3]] == [32, 64 + 33, 32]
    rows = spark.createDataFrame([(key, n) for n, key in enumerate(keys)], "k string, n int")
    other = spark.createDataFrame([(key,) for key in keys[::2] * 2], "k string")
    for how in ("left_semi", "left_anti"):
        assert sorted(folders.join_keys(rows, other, "k", how).collect(), key=str) == sorted(rows.join(other, "k", how).collect(), key=str)


def test_a_batch_moves_its_halves_once(spark, tmp_path):
    """what is fresh and what is kept meet in one shuffle, which has no hashed ids; events with both pages and rows that
    are kept already are known behind it."""
    kept = ingest.Kept(spark, str(tmp_path)).halves.schema
    base = {field.name: None for field in kept} | {"source": "a", "lang": "en", "page_id": 1, "pos": 0, "hop": 0, "run": 0}
    fresh = [base | {"link_key": "k"}, base | {"link_key": "l", "page_id": 2}, base | {"link_key": None, "hop": 1, "lang": "zh"}]
    fresh += [base | {"source": R.ASIA_WORLD_EXPO, "link_key": key, "lang": "zh", "page_id": 5} for key in ("e", None)]
    before = [base | {"link_key": "k"}, base | {"link_key": "l", "page_id": 3, "hop": 1, "lang": "zh"}, base | {"link_key": None, "page_id": 9}]
    before += [base | {"source": R.ASIA_WORLD_EXPO, "link_key": key, "page_id": 4} for key in ("e", None)]
    one, two = (ingest.with_event_id(spark.createDataFrame(rows, kept).drop("run")) for rows in (fresh, before))
    found = ingest.met(one, two)
    said = {(r.source == "a", r.link_key, r.hop, r.lang): (r.both, r.new) for r in found.collect()}
    assert said == {
        (True, "k", 0, "en"): (False, False), (True, "l", 0, "en"): (True, True), (True, "l", 1, "zh"): (True, False),
        (True, None, 0, "en"): (True, False), (True, None, 1, "zh"): (True, True),
        (False, "e", 0, "en"): (True, False), (False, "e", 0, "zh"): (True, True), (False, None, 0, "en"): (False, False), (False, None, 0, "zh"): (False, True),
    }
    assert found.columns == [*one.columns, "both", "new"]
    plan = ingest.met(one, two)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(source#" in plan and "Join" not in plan
