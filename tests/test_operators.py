"""Links, fields, pairing, classes and records on small tables."""

import datetime
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from playbill.operators import bilingual, classify, fields, links, records
from playbill.plans import catalog, rules as R, venues
from playbill.plans.rendering import AS_OF
from playbill.schema import EVENT_COLUMNS
from playbill.sources import pages as P

def halves(spark, rows):
    """Half records from (lang, page_id, key, name, start) rows."""
    base = spark.createDataFrame(
        [(lang, page, key, name, start) for lang, page, key, name, start in rows],
        "lang string, page_id long, key string, name string, start date",
    )
    return catalog.half_rows(
        base,
        lang=F.col("lang"),
        hop=F.when(F.col("lang") == "en", 0).otherwise(1),
        page_id=F.col("page_id"),
        link_key=F.col("key"),
        event_name_eng=F.when(F.col("lang") == "en", F.col("name")),
        event_name_chi=F.when(F.col("lang") == "zh", F.col("name")),
        start_date=F.col("start"),
    )


def test_links_are_made_absolute_and_filtered_by_host(spark):
    df = spark.createDataFrame([("/a",), ("HTTP://x.example/b",), ("http://www.y.example/c",)], "link string")
    out = links.absolutise(df, "http://www.y.example")
    assert [r.link for r in out.collect()] == ["http://www.y.example/a", "HTTP://x.example/b", "http://www.y.example/c"]
    assert links.same_host(out, "www.y.example").count() == 2


def test_first_links_keeps_the_first(spark):
    rows = [("s", "a", 1, 0), ("s", "b", 1, 1), ("s", "a", 1, 2), ("s", "a", 0, 5), ("t", "a", 9, 9)]
    df = spark.createDataFrame(rows, "source string, link string, page_id int, pos int")
    out = links.first_links(df, ("source", "link"), ("page_id", "pos"))
    assert sorted(map(tuple, out.collect())) == [("s", "a", 0, 5), ("s", "b", 1, 1), ("t", "a", 9, 9)]
    assert out.columns == df.columns


def test_first_links_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("s").alias("source"), F.lit("a").alias("link"), F.col("id").alias("page_id"))
    plan = links.first_links(df, ("source", "link"), ("page_id",))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_min" in plan[exchange:] and "Window" not in plan


def test_every_second(spark):
    df = spark.createDataFrame([(i, link) for i, link in enumerate("aabb")], "pos int, link string")
    assert [r.link for r in links.every_second(df).collect()] == ["a", "b"]


def test_field_rules_fall_back_and_skip_placeholders(spark):
    rules = [
        fields.FieldRule("s", "en", "name", 1, "<h1>([^<]*)", "Film Screenings"),
        fields.FieldRule("s", "en", "name", 2, "<h2>([^<]*)"),
        fields.FieldRule("s", "zh", "name", 1, "<h3>([^<]*)"),
    ]
    rows = [("s", "en", "<h1>A</h1><h2>B</h2>"), ("s", "en", "<h1>Film Screenings</h1><h2>B</h2>"),
            ("s", "en", "<h1></h1><h2>B</h2>"), ("s", "zh", "<h1>A</h1>"), ("t", "en", "<h1>A</h1>")]
    df = spark.createDataFrame(rows, "source string, lang string, html string")
    assert [r.name for r in fields.extract_fields(df, rules).collect()] == ["A", "B", "B", None, None]


def test_zip_lists_pads_and_tells(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, ["c"], ["z"]), (3, [], [])], "id int, l array<string>, r array<string>")
    out = fields.zip_lists(df, ("id",), left=F.col("l"), right=F.col("r"))
    assert [tuple(r) for r in out.collect()] == [(1, 0, "a", "x", False), (1, 1, "b", None, False), (2, 0, "c", "z", True)]


def test_pairing_keeps_events_without_a_twin_and_ignores_copies(spark):
    day = datetime.date(2020, 6, 1)
    rows = [("en", 1, "a", "A", day), ("en", 2, "a", "copy", None), ("zh", 3, "a", "甲", None), ("en", 4, "b", "B", day),
            ("zh", 5, "c", "丙", None)]
    out = bilingual.pair_languages(halves(spark, rows)).orderBy("event_name_eng").collect()
    assert [(r.event_name_eng, r.event_name_chi, r.start_date, r.has_twin) for r in out] == [
        ("A", "甲", day, True), ("B", None, day, False)]


def test_pairing_is_one_shuffle_and_carries_no_html(spark):
    pages = spark.createDataFrame([], "page_id long, source string, page_kind string, lang string, url string, html string, fetched_at timestamp")
    events = venues.extract_events(pages.repartition(3), AS_OF, [R.WEST_KOWLOON, R.TAI_KWUN, R.TOURISM_BOARD])
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    shuffled = events._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in shuffled.splitlines() if "Aggregate [source" in line)
    assert "html" not in aggregate


def test_keyed_merge(spark):
    one, two = datetime.date(2020, 1, 1), datetime.date(2020, 2, 2)
    rows = [("en", 1, "1", "E1", one), ("en", 1, "2", "E2", one), ("en", 2, "2", "again", two),
            ("zh", 3, "2", "前", two), ("zh", 4, "2", "後", two), ("zh", 3, "3", "丙前", one), ("zh", 4, "3", "丙後", two)]
    out = bilingual.merge_languages(halves(spark, rows)).orderBy("event_id").collect()
    assert [(r.event_id, r.event_name_eng, r.event_name_chi, r.start_date) for r in out] == [
        ("1", "E1", None, one), ("2", "E2", "後", one), ("3", None, "丙後", one)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12), max_size=15), st.lists(st.integers(0, 12), max_size=15))
def test_keyed_merge_keeps_every_id_once(spark, english, chinese):
    rows = [("en", i, str(k), f"E{k}", None) for i, k in enumerate(english)]
    rows += [("zh", i, str(k), f"Z{k}", None) for i, k in enumerate(chinese)]
    out = [r.event_id for r in bilingual.merge_languages(halves(spark, rows)).collect()]
    assert sorted(out) == sorted({str(k) for k in english + chinese})


def test_fee_page_address(spark):
    rows = [("http://f.example/zh_TW/web/1/page.html",), ("https://f.example/a/",)]
    df = spark.createDataFrame(rows, "u string")
    assert [r.x for r in df.select(bilingual.fee_page_url(F.col("u")).alias("x")).collect()] == [
        "https://f.example/zh_TW/web/1/ticketinfo.html", "https://f.example/a/ticketinfo.html"]


def test_events_without_need_of_a_fee_do_not_meet_in_one_task(spark):
    events = spark.range(2000).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("$1").alias("fee"),
                                      F.lit("https://f.example/x").alias("link_chi"))
    fees = spark.createDataFrame([("https://f.example/ticketinfo.html", "$9", 1, 1)], "url string, fee string, fetched_at int, page_id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = bilingual.lookup_fees(events, fees)
        sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert out.count() == 2000 and sizes < 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_location_serves_both_languages(spark):
    df = spark.createDataFrame([(None, "廳"), ("Hall", None), ("Hall", "廳"), (None, None)], "location_eng string, location_chi string")
    out = [tuple(r) for r in bilingual.fill_location(df).collect()]
    assert out == [("廳", "廳"), ("Hall", "Hall"), ("Hall", "廳"), (None, None)]


def test_classes(spark):
    rules = R.TYPE_RULES[R.THE_MILLS]
    df = spark.createDataFrame([("Concert and Workshop",), ("Market day",), ("年度展銷會",), (None,)], "title string")
    kind = classify.classify(F.col("title"), rules)
    out = df.select(kind.alias("en"), classify.translate_type(kind, rules).alias("zh")).collect()
    assert [tuple(r) for r in out] == [("Workshop", "工作坊"), (None, None), ("Sale", "展銷會"), (None, None)]


def test_records_conform(spark):
    df = spark.createDataFrame([("1", R.THE_MILLS, None), ("2", R.PMQ, None), ("3", R.TRADE_COUNCIL, "Hall")],
                               "event_id string, source string, location_eng string")
    plain = records.conform(df, R.DEFAULTS).orderBy("event_id").collect()
    assert tuple(plain[0].asDict()) == EVENT_COLUMNS
    assert [(r.fee, r.location_eng, r.location_chi) for r in plain] == [
        ("Free admission", None, None), (None, None, None), (None, "Hall", "網上直播")]
    marked = records.conform(df, R.published_defaults()).orderBy("event_id").collect()
    assert [(r.fee, r.location_eng, r.event_name_eng, r.link_eng) for r in marked] == [
        ("Free admission", "N/A", "", ""), ("N/A", "N/A", "", "N/A"), ("N/A", "Hall", "", "")]


def test_transport_columns_go(spark):
    df = spark.createDataFrame([(1, 2, 3)], "event_id int, depth int, redirect_urls int")
    assert records.drop_transport(df).columns == ["event_id"]


def test_header_filter(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],)], "h array<string>")
    assert df.where(records.valid_header(F.col("h"))).count() == 1


def test_page_chain_follows_to_the_end_and_survives_loops(spark):
    edges = [("s", f"p{i}", f"p{i + 1}") for i in range(150)] + [("s", "p150", "p20"), ("t", "a", "b"), ("t", "b", None)]
    edges = spark.createDataFrame(edges, "source string, url string, next_url string")
    seeds = spark.createDataFrame([("s", "p0"), ("s", "p100"), ("t", "a"), ("u", "alone")], "source string, url string")
    out = {(r.source, r.url): r.depth for r in P.page_chain(seeds, edges).collect()}
    expected = {("s", f"p{i}"): i if i < 100 else i - 100 for i in range(151)}
    expected.update({("s", f"p{i}"): min(i, 51 + i - 20) for i in range(20, 100)})
    assert out == {**expected, ("t", "a"): 0, ("t", "b"): 1, ("u", "alone"): 0}


def test_seeds(spark):
    urls = {r.url for r in venues.seed_addresses(spark).collect()}
    assert "https://www.pmq.org.hk/happenings/programmes-events/?lang=ch&past=1&date=202012" in urls
    assert "http://www.themills.com.hk/en/event/page/19" in urls
    assert "https://asiasociety.org/hong-kong/events?page=0" in urls
    assert len(urls) == 2 + 2 + 1 + 1 + 1 + 3 + 12 + 1 + 1 + 19 + 1


def test_page_chain_agrees_with_breadth_first_search(spark, monkeypatch):
    """Chains that meet, loops, several seeds on a chain, pages without a next one; also without broadcasts."""
    rng = random.Random(3)
    following = {f"p{i}": f"p{rng.choice([i + 1, i + 1, i + 1, rng.randrange(120)])}" for i in range(120) if rng.random() < 0.95}
    seeds = [f"p{i}" for i in rng.sample(range(120), 9)] + ["lonely"]
    depth, at = dict.fromkeys(seeds, 0), list(seeds)
    while at:
        at = [following[u] for u in at if u in following and depth.setdefault(following[u], depth[u] + 1) == depth[u] + 1 and following[u] not in seeds]
        at = list(dict.fromkeys(at))
        if max(depth.values()) > 500:
            break
    edges = spark.createDataFrame([("s", u, v) for u, v in following.items()] + [("s", "end", None)], "source string, url string, next_url string")
    roots = spark.createDataFrame([("s", u) for u in seeds * 2], "source string, url string")
    for rows in (P.BROADCAST_ROWS, 0):
        monkeypatch.setattr(P, "BROADCAST_ROWS", rows)
        found = P.page_chain(roots, edges).collect()
        assert {r.url: r.depth for r in found} == depth and len(found) == len(depth)
    assert P.page_chain(roots.limit(0), edges).count() == 0


def test_only_events_without_a_fee_move(spark):
    """The join's exchange has the events that need a ticket page, and no others."""
    rows = [(f"e{i}", "$5" if i % 10 else None, f"http://x.example/{i}/page.html" if i % 20 else None) for i in range(1000)]
    events = spark.createDataFrame(rows, "event_id string, fee string, link_chi string")
    fees = spark.createDataFrame([(f"https://x.example/{i}/ticketinfo.html", f"${i}", datetime.datetime(2020, 1, 1), i) for i in range(0, 1000, 4)],
                                 "url string, fee string, fetched_at timestamp, page_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bilingual.lookup_fees(events, fees)
        assert {r.event_id: r.fee for r in found.collect()} == {
            i: fee if fee or not link or int(i[1:]) % 4 else f"${i[1:]}" for i, fee, link in rows}
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        moved = final[final.index("Exchange hashpartitioning(_fee_key") :].split("Scan", 1)[0]
        assert "isnull(fee" in moved, final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_location_serves_both_languages(spark):
    df = spark.createDataFrame([(None, "廳"), ("Hall", None), ("Hall", "廳"), (None, None)], "location_eng string, location_chi string")
    out = [tuple(r) for r in bilingual.fill_location(df).collect()]
    assert out == [("廳", "廳"), ("Hall", "Hall"), ("Hall", "廳"), (None, None)]


def test_classes(spark):
    rules = R.TYPE_RULES[R.THE_MILLS]
    df = spark.createDataFrame([("Concert and Workshop",), ("Market day",), ("年度展銷會",), (None,)], "title string")
    kind = classify.classify(F.col("title"), rules)
    out = df.select(kind.alias("en"), classify.translate_type(kind, rules).alias("zh")).collect()
    assert [tuple(r) for r in out] == [("Workshop", "工作坊"), (None, None), ("Sale", "展銷會"), (None, None)]


def test_records_conform(spark):
    df = spark.createDataFrame([("1", R.THE_MILLS, None), ("2", R.PMQ, None), ("3", R.TRADE_COUNCIL, "Hall")],
                               "event_id string, source string, location_eng string")
    plain = records.conform(df, R.DEFAULTS).orderBy("event_id").collect()
    assert tuple(plain[0].asDict()) == EVENT_COLUMNS
    assert [(r.fee, r.location_eng, r.location_chi) for r in plain] == [
        ("Free admission", None, None), (None, None, None), (None, "Hall", "網上直播")]
    marked = records.conform(df, R.published_defaults()).orderBy("event_id").collect()
    assert [(r.fee, r.location_eng, r.event_name_eng, r.link_eng) for r in marked] == [
        ("Free admission", "N/A", "", ""), ("N/A", "N/A", "", "N/A"), ("N/A", "Hall", "", "")]


def test_transport_columns_go(spark):
    df = spark.createDataFrame([(1, 2, 3)], "event_id int, depth int, redirect_urls int")
    assert records.drop_transport(df).columns == ["event_id"]


def test_header_filter(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],)], "h array<string>")
    assert df.where(records.valid_header(F.col("h"))).count() == 1


def test_page_chain_follows_to_the_end_and_survives_loops(spark):
    edges = [("s", f"p{i}", f"p{i + 1}") for i in range(150)] + [("s", "p150", "p20"), ("t", "a", "b"), ("t", "b", None)]
    edges = spark.createDataFrame(edges, "source string, url string, next_url string")
    seeds = spark.createDataFrame([("s", "p0"), ("s", "p100"), ("t", "a"), ("u", "alone")], "source string, url string")
    out = {(r.source, r.url): r.depth for r in P.page_chain(seeds, edges).collect()}
    expected = {("s", f"p{i}"): i if i < 100 else i - 100 for i in range(151)}
    expected.update({("s", f"p{i}"): min(i, 51 + i - 20) for i in range(20, 100)})
    assert out == {**expected, ("t", "a"): 0, ("t", "b"): 1, ("u", "alone"): 0}


def test_seeds(spark):
    urls = {r.url for r in venues.seed_addresses(spark).collect()}
    assert "https://www.pmq.org.hk/happenings/programmes-events/?lang=ch&past=1&date=202012" in urls
    assert "http://www.themills.com.hk/en/event/page/19" in urls
    assert "https://asiasociety.org/hong-kong/events?page=0" in urls
    assert len(urls) == 2 + 2 + 1 + 1 + 1 + 3 + 12 + 1 + 1 + 19 + 1


def test_page_chain_agrees_with_breadth_first_search(spark, monkeypatch):
    """Chains that meet, loops, several seeds on a chain, pages without a next one; also without broadcasts."""
    rng = random.Random(3)
    following = {f"p{i}": f"p{rng.choice([i + 1, i + 1, i + 1, rng.randrange(120)])}" for i in range(120) if rng.random() < 0.95}
    seeds = [f"p{i}" for i in rng.sample(range(120), 9)] + ["lonely"]
    depth, at = dict.fromkeys(seeds, 0), list(seeds)
    while at:
        at = [following[u] for u in at if u in following and depth.setdefault(following[u], depth[u] + 1) == depth[u] + 1 and following[u] not in seeds]
        at = list(dict.fromkeys(at))
        if max(depth.values()) > 500:
            break
    edges = spark.createDataFrame([("s", u, v) for u, v in following.items()] + [("s", "end", None)], "source string, url string, next_url string")
    roots = spark.createDataFrame([("s", u) for u in seeds * 2], "source string, url string")
    for rows in (P.BROADCAST_ROWS, 0):
        monkeypatch.setattr(P, "BROADCAST_ROWS", rows)
        found = P.page_chain(roots, edges).collect()
        assert {r.url: r.depth for r in found} == depth and len(found) == len(depth)
    assert P.page_chain(roots.limit(0), edges).count() == 0


def test_only_events_without_a_fee_move(spark):
    """The join's exchange has the events that need a ticket page, and no others."""
    rows = [(f"e{i}", "$5" if i % 10 else None, f"http://x.example/{i}/page.html" if i % 20 else None) for i in range(1000)]
    events = spark.createDataFrame(rows, "event_id string, fee string, link_chi string")
    fees = spark.createDataFrame([(f"https://x.example/{i}/ticketinfo.html", f"${i}", datetime.datetime(2020, 1, 1), i) for i in range(0, 1000, 4)],
                                 "url string, fee string, fetched_at timestamp, page_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bilingual.lookup_fees(events, fees)
        assert {r.event_id: r.fee for r in found.collect()} == {
            i: fee if fee or not link or int(i[1:]) % 4 else f"${i[1:]}" for i, fee, link in rows}
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        moved = final[final.index("Exchange hashpartitioning(_fee_key") :].split("Scan", 1)[0]
        assert "isnull(fee" in moved, final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
