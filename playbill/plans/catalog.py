"""The query catalogue: every operator as a query over the given tables, with its SQL twin.

The SQL states what the query has to find, from the columns of the tables. Where a query reads
pages that were rendered from a table, the SQL does not know the pages at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates as D
from ..functions import html as H
from ..functions import text as X
from ..functions import tokens as K
from ..operators import bilingual, classify, fields, links, records, rule_tables
from ..schema import HALF_FIELDS, TEXT_FIELDS
from ..session import scratch_dir, with_method_limit
from ..sources import pages as P
from ..sources import store as S
from ..streaming import ingest
from . import rendering as W
from . import rules as R
from . import venues

Query = Callable[[SparkSession, str], DataFrame]

SHOWS_A_TASK = 50_000  # a row becomes up to ten pages or fourteen texts

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: function(with_method_limit(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return P.spread(W.show_rows(table(spark, folder, "orders")), spark.sparkContext.defaultParallelism, SHOWS_A_TASK)


def stored_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages as a crawl leaves them: a table partitioned by source and kind."""
    path = scratch_dir(spark, "pages")
    P.store_pages(pages, path)
    return P.load_pages(spark, path)


def day(column: str | Column) -> Column:
    """Dates leave as text, which both engines write alike."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# ---------------------------------------------------------------- links


@query(
    "page_links",
    """
    SELECT page_id, unnest(range(0, len(l))) AS pos, unnest(l) AS link
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)
    """,
)
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    found = links.extract_links(table(spark, folder, "pages"))
    return found.withColumn("pos", F.col("pos").cast("long"))


@query(
    "page_links_absolute",
    """
    SELECT page_id, pos, host || link AS link
    FROM (
        SELECT page_id, unnest(range(0, len(l))) AS pos, unnest(l) AS link, host
        FROM (
            SELECT page_id, regexp_extract(url, '^https?://[^/]*') AS host,
                   regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l
            FROM pages
        )
    )
    WHERE host LIKE '%://www.%'
    """,
)
def page_links_absolute(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").withColumn("base", F.regexp_extract("url", "^https?://[^/]*", 0))
    found = links.absolutise(links.extract_links(pages, keep=("base",)), F.col("base"))
    found = links.same_host(found, F.concat(F.lit("www."), F.regexp_extract("base", r"://www\.(.*)$", 1)))
    return found.select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query(
    "links_dedup_first",
    """
    SELECT source, link, page_id, pos FROM (
        SELECT *, row_number() OVER (PARTITION BY source, link ORDER BY page_id, pos) AS rn
        FROM (
            SELECT regexp_extract(url, '/([a-z][a-z])/', 1) AS source, page_id,
                   unnest(range(0, len(l))) AS pos, unnest(l) AS link
            FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)
        )
    ) WHERE rn = 1
    """,
)
def links_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").withColumn("source", F.regexp_extract("url", "/([a-z][a-z])/", 1))
    found = links.extract_links(pages, keep=("source",))
    first = links.first_links(found, ("source", "link"), ("page_id", "pos"))
    return first.select("source", "link", "page_id", F.col("pos").cast("long").alias("pos"))


@query(
    "every_second_link",
    """
    SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, l[i] AS link
    FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
          FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))
    WHERE i % 2 = 1
    """,
)
def every_second_link(spark: SparkSession, folder: str) -> DataFrame:
    found = links.every_second(links.extract_links(table(spark, folder, "pages")))
    return found.withColumn("pos", F.col("pos").cast("long"))


@query(
    "deny_filter",
    """
    WITH found AS (
        SELECT page_id, url LIKE '%spam-farm%' AS spam, unnest(range(0, len(l))) AS pos,
               unnest(l) AS link
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)
    )
    SELECT page_id, pos, link FROM found f
    WHERE NOT EXISTS (SELECT 1 FROM found d WHERE d.spam AND d.link = f.link)
    """,
)
def deny_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Links that no page of a known spam host carries as well."""
    pages = table(spark, folder, "pages")
    found = links.extract_links(pages)
    spam = links.extract_links(pages.where(F.col("url").contains("spam-farm")))
    kept = links.without_denied(found, spam.select(F.col("link").alias("url")).distinct())
    return kept.select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query(
    "card_links",
    """
    SELECT o_orderkey AS page_id,
           'http://www.themills.com.hk/en/event/' || CASE WHEN o_orderstatus = 'P' THEN 'b' ELSE 'a' END
           || o_orderkey AS link
    FROM orders WHERE o_orderpriority <> '1-URGENT'
    """,
)
def card_links(spark: SparkSession, folder: str) -> DataFrame:
    """Cards with an image and a page, and one refused address; cards without a date do not count."""
    shows = orders(spark, folder)
    page = W.template(
        '<div class="col-xs-12 col-sm-6 pull-left"><div>{date}</div><a href="http://www.themills.com.hk/pic/{k}.jpg">'
        '</a><div><a href="http://www.themills.com.hk/{first}">go</a></div>'
        '<a href="http://www.themills.com.hk/en/event/b{k}">more</a></div><a href="http://www.themills.com.hk/x">x</a>',
        k=F.col("k"),
        date=F.when(F.col("n") == 1, F.lit("soon")).otherwise(F.lit('<div class="date">today</div>')),
        first=F.when(F.col("s") == "P", F.lit("artymoment/")).otherwise(F.concat(F.lit("en/event/a"), "k")),
    )
    pages = shows.select(F.col("k").alias("page_id"), page.alias("html"))
    cards = links.card_links(pages, R.MILLS_CARD, R.MILLS_DATED, R.MILLS_PREFIX)
    return links.first_of_card(links.without_denied(cards, R.DENIED)).select("page_id", "link")


@query(
    "detail_links",
    """
    WITH o AS (
        SELECT o_orderkey AS k, o_orderstatus AS s FROM orders
    ), entries AS (
        SELECT 'Asia Society' AS source, 'https://asiasociety.org/hk/' || k AS link, s FROM o
        UNION ALL SELECT 'Hong Kong Film Archive', 'http://film.example/en_US/' || k || '.html', s FROM o
        UNION ALL SELECT 'Hong Kong Museum of Arts', 'http://hk.art.museum/en_US/web/ma/show' || k || '.html', s FROM o
        UNION ALL SELECT 'HKTDC', 'http://www.hktdc.com/fair/tc/' || k, s FROM o WHERE s <> 'P'
        UNION ALL SELECT 'PMQ', 'https://pmq.example/?lang=ch&p=' || k, s FROM o
        UNION ALL SELECT 'West Kowloon Cultural District', 'https://west.example/en/' || k, s FROM o
        UNION ALL SELECT 'HKTB', 'https://board.example/?a=1&k=' || k, s FROM o
        UNION ALL SELECT 'Tai Koo Place', 'http://www.taikooplace.com/en/show/' || k, s FROM o
        UNION ALL SELECT 'Tai Kwun', 'https://www.taikwun.hk/en/show/' || k, s FROM o
        UNION ALL SELECT 'The Mills', 'http://www.themills.com.hk/' || k || '/', s FROM o
    )
    SELECT source, link FROM entries
    """,
)
def detail_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links on rendered list pages of ten venues; the list pages also link elsewhere."""
    shows = orders(spark, folder)
    lists = {
        R.ASIA_SOCIETY: '<h4 class="card-title"><a href="hk/{k}">x</a></h4><h4><a href="no">x</a></h4>',
        R.FILM_ARCHIVE: '<a href="no">x</a><table class="table_main"><a class="b" href="http://film.example/en_US/{k}.html">x'
                        '</a><a href="http://film.example/en_US/{k}.html">again</a></table>',
        R.MUSEUM_OF_ART: '<div class="journal-content-article"><ul><li><div><a href="show{k}.html">x</a></div></li></ul></div>'
                         '<a href="no">x</a>',
        R.TRADE_COUNCIL: '<td class="content_black_middle padding_right_5px"><a href="http://{host}/fair/tc/{k}">x</a></td>',
        R.PMQ: '<div class="bgWhite container gapPaddingBtm40 gapBtm40"><div class="col-xs-6"><a href="https://pmq.example/?lang=ch&p={k}">'
               '</a></div><div class="col-xs-6"><a href="https://pmq.example/?lang=ch&p={k}#b">x</a></div></div>',
        R.WEST_KOWLOON: '<div id="main"><ul><li><h4><a href="https://west.example/en/{k}">x</a></h4></li></ul></div><h4><a href="no">x</a></h4>',
        R.TOURISM_BOARD: "<nav><a href='no'>x</a></nav><DIV id='event-calendar'><div><div><A HREF='https://board.example/?a=1&amp;k={k}'>x</A></div></div></DIV>"
                         '<footer><a href="https://social.example/">x</a></footer>',
        R.TAIKOO: '<form id="mainform"><header><a href="/en/contact">x</a></header><div><div><a href=/en/show/{k}>x</a></div></div>'
                  '<footer><a href="/en/legal">x</a></footer></form>',
        R.TAI_KWUN: '<div><a href="no">x</a></div><div class="list" id="programme-list"><div class="container"><div><a href="show/{k}">x</a></div></div></div>'
                    '<div><a href="https://social.example/">x</a></div>',
        R.THE_MILLS: '<a href="http://www.themills.com.hk/contact/">x</a><div class="col-xs-12 col-sm-6 pull-left"><div class="date">1</div>'
                     '<a href="http://www.themills.com.hk/{k}/">x</a></div><footer><a href="http://www.themills.com.hk/legal/">x</a></footer>',
    }
    host = F.when(F.col("s") == "P", F.lit("other.example")).otherwise(F.lit("www.hktdc.com"))
    rendered = [
        W.page_rows(shows, source, ("list", "en", F.lit("http://list.example"),
                                 W.template(html, k=F.col("k"), host=host), None))
        for source, html in lists.items()
    ]
    pages = stored_pages(spark, records.union_sources(rendered))
    return venues.detail_links(pages).select("source", "link")


@query(
    "seed_months",
    """
    WITH span AS (
        SELECT o_custkey AS source, date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi
        FROM orders GROUP BY o_custkey
    )
    SELECT source, 'https://list.example/?date=' || strftime(m, '%Y%m') AS url
    FROM (SELECT source, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM span)
    """,
)
def seed_months(spark: SparkSession, folder: str) -> DataFrame:
    spans = orders(spark, folder).groupBy(F.col("c").alias("source")).agg(
        F.min("d").alias("lo"), F.max("d").alias("hi")
    )
    seeds = spans.withColumn("url", F.lit("https://list.example/?date="))
    return P.seed_months(seeds, "lo", "hi").select("source", "url")


@query(
    "seed_pages",
    """
    SELECT o_orderkey AS source, 'https://list.example/' || o_orderkey || '/page/' || i || '/' AS url
    FROM orders, unnest(range(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1)) t(i)
    """,
)
def seed_pages(spark: SparkSession, folder: str) -> DataFrame:
    seeds = orders(spark, folder).select(
        F.col("k").alias("source"), F.concat(F.lit("https://list.example/"), "k", F.lit("/page/")).alias("url"), "n"
    )
    return P.seed_pages(seeds, F.lit(1), "n", "/").select("source", "url")


@query(
    "page_chain",
    """
    WITH p AS (
        SELECT page_id, url, regexp_extract(url, '/([a-z][a-z])/', 1) AS lang FROM pages
    ), marked AS (
        SELECT *, CASE WHEN lag(lang) OVER (ORDER BY page_id) = lang
                        AND lag(page_id) OVER (ORDER BY page_id) = page_id - 1 THEN 0 ELSE 1 END AS starts FROM p
    ), runs AS (
        SELECT *, sum(starts) OVER (ORDER BY page_id) AS run FROM marked
    )
    SELECT lang AS source, url, CAST(row_number() OVER (PARTITION BY run ORDER BY page_id) - 1 AS BIGINT) AS depth
    FROM runs
    """,
)
def page_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A page links to the next one of its language; a chain begins where no page links to it."""
    pages = table(spark, folder, "pages").select(
        "page_id", "url", F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("source")
    )
    following = pages.select((F.col("page_id") - 1).alias("page_id"), "source", F.col("url").alias("next"))
    listed = pages.join(following, ["page_id", "source"], "left")
    link = F.concat(F.lit('<a class="next" href="'), "next", F.lit('">next</a>'))
    listed = listed.withColumn("html", F.concat(F.lit('<a class="prev" href="#">back</a>'), F.coalesce(link, F.lit(""))))
    edges = links.next_pages(listed)
    linked = edges.where("next_url is not null").select("source", F.col("next_url").alias("url"))
    seeds = pages.select("source", "url").join(linked, ["source", "url"], "left_anti")
    return P.page_chain(seeds, edges)


# ---------------------------------------------------------------- texts and fields


@query(
    "page_titles",
    """
    SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) AS title, regexp_extract(html, '<h1>([^<]*)', 1) AS heading,
           coalesce(nullif(regexp_extract(html, '<h2>([^<]*)', 1), ''), nullif(regexp_extract(html, '<h1>([^<]*)', 1), ''))
           AS name, nullif(regexp_extract(html, 'meta charset="([^"]*)', 1), '') AS charset
    FROM pages
    """,
)
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Fields by rules, with a fallback chain."""
    rules = [
        fields.FieldRule("web", "any", "title", 1, r"<title[^>]*>([^<]*)"),
        fields.FieldRule("web", "any", "heading", 1, r"<h1[^>]*>([^<]*)"),
        fields.FieldRule("web", "any", "name", 1, r"<h2[^>]*>([^<]*)"),
        fields.FieldRule("web", "any", "name", 2, r"<h1[^>]*>([^<]*)"),
        fields.FieldRule("web", "any", "charset", 1, r'<meta\s[^>]*charset="([^"]*)'),
    ]
    pages = table(spark, folder, "pages").withColumns({"source": F.lit("web"), "lang": F.lit("any")})
    return fields.extract_fields(pages, rules).select("page_id", "title", "heading", "name", "charset")


_UNESCAPED = (
    "replace(replace(replace(replace(replace(replace(replace(replace({}, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
)


@query(
    "page_text_clean",
    f"""
    WITH a AS (
        SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages
    ), t AS (
        SELECT page_id, body, [y FOR y IN [
                   regexp_replace(replace(replace({_UNESCAPED.format('x')}, '  ', ''), chr(10), ''), '^ ', '')
                   FOR x IN regexp_split_to_array(body, '<[^>]*>')] IF y NOT IN ('', ' ')] AS tokens
        FROM a
    )
    SELECT page_id, nullif(replace(replace(replace(replace({_UNESCAPED.format("regexp_replace(body, '</?[^>]*>', '', 'g')")},
                   chr(10), ''), chr(9), ''), chr(13), ' '), chr(160), ' '), '') AS body_text,
           nullif(array_to_string(tokens, chr(10)), '') AS lines, CAST(len(tokens) AS BIGINT) AS n_tokens,
           tokens[1] AS first_token
    FROM t
    """,
)
def page_text_clean(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "page_id", F.regexp_extract("html", r"(?s)<article[^>]*>(.*?)</article>", 1).alias("body")
    )
    pages = pages.withColumn("tokens", K.tokens_of(F.col("body"), K.BLANKS_FIRST))
    return pages.select(
        "page_id",
        X.clean_text(F.col("body")).alias("body_text"),
        K.join_tokens(F.col("tokens"), "\n").alias("lines"),
        F.size("tokens").cast("long").alias("n_tokens"),
        F.get("tokens", F.lit(0)).alias("first_token"),
    )


@query(
    "page_region",
    r"""
    SELECT page_id, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS ad,
           array_to_string([regexp_replace(x, '<[^>]*>', '', 'g') FOR x IN regexp_extract_all(html, '<li>(.*?)</li>', 1)], '|')
           AS nav,
           length(html) - length(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'))
           AS n_hidden
    FROM pages
    """,
)
def page_region(spark: SparkSession, folder: str) -> DataFrame:
    """Regions closed by their own tag, and what is invisible."""
    html = F.col("html")
    ads = H.element_bodies(html, r'<div[^>]*\bclass="ad"[^>]*>')
    nav = F.get(H.element_bodies(html, "<nav[^>]*>", "nav"), F.lit(0))
    items = F.transform(H.element_bodies(nav, "<li>", "li"), X.strip_tags)
    return table(spark, folder, "pages").select(
        "page_id",
        F.get(ads, F.lit(0)).alias("ad"),
        F.array_join(items, "|").alias("nav"),
        (F.length(html) - F.length(H.drop_invisible(html))).cast("long").alias("n_hidden"),
    )


@query(
    "clean_tokens",
    """
    SELECT doc_id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens,
           array_to_string([lower(x) FOR x IN t], '|') AS lowered
    FROM (
        SELECT doc_id, [y FOR y IN [regexp_replace(replace(replace(x, '  ', ''), chr(10), ''), '^ ', '')
                                    FOR x IN string_split(text, '.')] IF y NOT IN ('', ' ')] AS t
        FROM documents
    )
    """,
)
def clean_tokens(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.split("text", r"\.").alias("raw"))
    documents = documents.withColumn("tokens", K.clean_tokens(F.col("raw"), K.BLANKS_FIRST))
    return documents.select(
        "doc_id",
        F.array_join("tokens", "|").alias("tokens"),
        F.size("tokens").cast("long").alias("n_tokens"),
        F.array_join(K.lower_tokens(F.col("tokens")), "|").alias("lowered"),
    )


@query(
    "count_pieces",
    """
    SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS n_the,
           CAST(length(text) - length(replace(text, '.', '')) AS BIGINT) AS n_stops
    FROM documents
    """,
)
def count_pieces(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        K.count_of(text, "the").cast("long").alias("n_the"),
        K.count_of(text, ".").cast("long").alias("n_stops"),
    )


@query(
    "take_until_sentinel",
    """
    SELECT doc_id, nullif(array_to_string(
               CASE WHEN list_position(w[2:], 'the') > 0 THEN w[1:list_position(w[2:], 'the')] ELSE w END, chr(10)), '')
           AS lead
    FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
    """,
)
def take_until_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    words = F.split("text", " ")
    return table(spark, folder, "documents").withColumn("words", words).select(
        "doc_id", K.take_until(F.col("words"), "the").alias("lead")
    )


@query(
    "label_next_token",
    """
    SELECT o_orderkey AS k, 'Hall ' || o_custkey AS location,
           CASE WHEN o_orderstatus <> 'F' THEN '$' || CAST(floor(o_totalprice) AS BIGINT) END AS fee,
           strftime(o_orderdate, '%Y-%m-%d') AS date_text, CAST(NULL AS VARCHAR) AS organiser
    FROM orders
    """,
)
def label_next_token(spark: SparkSession, folder: str) -> DataFrame:
    """Labels in any case; the second alias counts; a label at the end has no value."""
    shows = orders(spark, folder)
    page = W.template(
        "<p>About {k}</p><p>When</p><p>soon</p><p>DATE</p><p>{d}</p><p>Venue</p><p> Hall {c}</p>{fee}<p>Organiser</p>",
        k=F.col("k"), d=F.col("d"), c=F.col("c"),
        fee=F.when(F.col("s") == "F", F.lit("")).otherwise(
            F.concat(F.lit("<p><b>Admission</b></p><p>$"), "price", F.lit("</p><p>Venue</p><p>elsewhere</p>"))
        ),
    )
    shows = shows.select("k", K.tokens_of(page).alias("tokens"))
    shows = shows.withColumn("lowered", K.lower_tokens(F.col("tokens")))
    rules = [
        fields.LabelRule("x", "location", "venue"),
        fields.LabelRule("x", "fee", "admission"),
        fields.LabelRule("x", "date_text", "when"),
        fields.LabelRule("x", "date_text", "date"),
        fields.LabelRule("x", "organiser", "organiser"),
    ]
    columns = fields.label_columns(F.col("tokens"), F.col("lowered"), rules, "x")
    return shows.withColumns(columns).select("k", *columns)


@query(
    "label_contains",
    """
    SELECT o_orderkey AS k, 'Hall ' || o_custkey AS location, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
           CAST(NULL AS VARCHAR) AS fee
    FROM orders
    """,
)
def label_contains(spark: SparkSession, folder: str) -> DataFrame:
    """The last cluster with the label counts, and case matters."""
    page = W.template(
        "<div>Venue:</div><div>nowhere</div><div>Event Date</div><div>From {d}</div><div>Main Venue</div><div>Hall {c}</div>"
        "<div>fee</div><div>1</div>",
        d=F.col("d"), c=F.col("c"),
    )
    clusters = F.regexp_extract_all(page, F.lit("<div>([^<]*)</div>"), F.lit(1))
    shows = orders(spark, folder).select("k", clusters.alias("clusters"))
    rules = [fields.LabelRule("x", name, label, "contains") for name, label in
             (("location", "Venue"), ("date_text", "Date"), ("fee", "Fee"))]
    shows = shows.withColumns(fields.label_columns(F.col("clusters"), F.col("clusters"), rules, "x"))
    shows = D.with_date_range(shows, "date_text", W.AS_OF)
    return shows.select("k", "location", day("start_date").alias("start_date"), "fee")


@query(
    "dl_lookup",
    """
    SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
           strftime(o_orderdate + to_days(7 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER)), '%Y-%m-%d') AS end_date,
           'Hall ' || o_custkey AS location, CAST(NULL AS VARCHAR) AS fee
    FROM orders
    """,
)
def dl_lookup(spark: SparkSession, folder: str) -> DataFrame:
    page = W.template(
        "<dl><dt> Date </dt>\n<dd>{d} to {e}</dd><dt>Venue</dt><dd>\n<b>Hall</b> {c}</dd></dl>",
        d=F.date_format("d", "dd.MM.yyyy"), e=F.date_format("e", "dd.MM.yyyy"), c=F.col("c"),
    )
    shows = orders(spark, folder).select("k", page.alias("html"))
    shows = shows.select(
        "k",
        H.definition(F.col("html"), "Date").alias("date_text"),
        X.clean_text(H.definition(F.col("html"), "Venue")).alias("location"),
        H.definition(F.col("html"), "Fee").alias("fee"),
    )
    shows = D.with_date_range(shows, "date_text", W.AS_OF)
    return shows.select("k", day("start_date").alias("start_date"), day("end_date").alias("end_date"), "location", "fee")


@query(
    "first_matching_token",
    """
    SELECT o_orderkey AS k, '票價：$' || CAST(floor(o_totalprice) AS BIGINT) AS word,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE '票價：$' || CAST(floor(o_totalprice) AS BIGINT) END AS price,
           'Cost $' || CAST(floor(o_totalprice) AS BIGINT) || ' each' AS around,
           '$' || CAST(floor(o_totalprice) AS BIGINT) AS plain,
           CAST(CAST(floor(o_totalprice) AS DECIMAL(10, 2)) AS VARCHAR) AS amount,
           ' Venue: Hall ' || o_custkey AS place,
           'Club ' || o_custkey AS organiser
    FROM orders
    """,
)
def first_matching_token(spark: SparkSession, folder: str) -> DataFrame:
    shows = orders(spark, folder)
    named = {"price": F.col("price"), "c": F.col("c")}
    tokens = F.array(
        F.lit(" — "),
        W.template("票價：${price}", **named),
        W.template("Come in. Venue: Hall {c}! Now", **named),
    )
    odd = F.when(F.col("s") == "F", F.array(F.lit("x $5.50"))).otherwise(F.array().cast("array<string>"))
    paragraphs = F.array(
        F.lit("<p>Was $5.50</p>"), F.lit("<p>free</p>"), W.template("<p>A <b>Cost ${price} each</b></p>", **named)
    )
    shows = shows.select("k", tokens.alias("t"), F.concat(odd, tokens).alias("u"), paragraphs.alias("p"),
                         W.template("[Online] Club {c} @ Talk", **named).alias("title"))
    around = X.fee_around_dollar(F.col("p"))
    return shows.select(
        "k",
        K.first_word_token(F.col("t")).alias("word"),
        K.first_price_token(F.col("u")).alias("price"),
        around.alias("around"),
        X.dollar_amount_text(around).alias("plain"),
        X.fee_amount(around).cast("string").alias("amount"),
        K.venue_sentence(F.col("t"), "venue", "Venue").alias("place"),
        X.organiser_of_title(F.col("title")).alias("organiser"),
    )


@query(
    "list_zip",
    """
    SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, link, caption, CAST(len(l) = len(c) AS VARCHAR) AS aligned
    FROM (
        SELECT page_id, l, c, unnest(range(1, greatest(len(l), len(c)) + 1)) AS i, l[i] AS link, c[i] AS caption
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l,
                     regexp_extract_all(html, '<b>([^<]*)', 1) AS c FROM pages)
    )
    """,
)
def list_zip(spark: SparkSession, folder: str) -> DataFrame:
    """Links and bold captions of a page side by side; the lists are of different length."""
    zipped = fields.zip_lists(
        table(spark, folder, "pages"),
        ("page_id",),
        link=H.link_targets(F.col("html")),
        caption=H.all_groups(F.col("html"), "<b>([^<]*)"),
    )
    return zipped.select("page_id", F.col("pos").cast("long").alias("pos"), "link", "caption",
                         F.col("aligned").cast("string").alias("aligned"))


# ---------------------------------------------------------------- dates


_D = "CAST(o_orderdate AS DATE)"


@query(
    "date_formats",
    f"""
    SELECT o_orderkey AS k, CAST(f AS BIGINT) AS form, CAST({_D} AS VARCHAR) AS date
    FROM orders, unnest(range(0, 9)) t(f)
    """,
)
def date_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Every order's date in each of the known formats."""
    forms = ["d MMM yyyy", "d MMMM yyyy", "dd/MM/yyyy", "d/M/yyyy", "dd.MM.yyyy", "yyyy-MM-dd", "yyyy.MM.dd",
             "yyyy年 M月 d日", "'  'd'  'MMM' 'yyyy' '"]
    texts = F.array(*[F.date_format("d", form) for form in forms])
    shows = orders(spark, folder).select("k", F.posexplode(texts).alias("form", "text"))
    shows = shows.withColumn("text", X.squeeze(F.col("text")))
    return shows.select("k", F.col("form").cast("long").alias("form"), day(D.parse_date(F.col("text"))).alias("date"))


@query(
    "date_ranges",
    f"""
    WITH o AS (
        SELECT o_orderkey AS k, {_D} AS d, {_D} + 7 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS e FROM orders
    )
    SELECT k, CAST(f AS BIGINT) AS form,
           CASE WHEN f = 10 THEN '2020-06-18' ELSE CAST(CAST(d AS DATE) AS VARCHAR) END AS start_date,
           CASE WHEN f IN (5, 9, 11) THEN NULL WHEN f IN (3, 4) THEN CAST(CAST(d AS DATE) AS VARCHAR)
                WHEN f IN (6, 7) THEN CAST(last_day(d) AS VARCHAR)
                WHEN f = 8 THEN CAST(CAST(make_date(year(d), 12, 31) AS DATE) AS VARCHAR)
                ELSE CAST(CAST(e AS DATE) AS VARCHAR) END AS end_date
    FROM o, unnest(range(0, 14)) t(f)
    """,
)
def date_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Every order's span in each form of a range; two forms inherit from the other side."""

    def span(left: str, glue: str, right: str, end: str | Column = "e") -> Column:
        return F.concat(F.date_format("d", left), F.lit(glue), F.date_format(end, right))

    month_end = F.last_day("d")
    year_end = F.make_date(F.year("d"), F.lit(12), F.lit(31))
    forms = [
        (span("d MMM, yyyy", " - ", "d MMM, yyyy"), "open"),
        (span("d MMMM yyyy", " to ", "d MMMM yyyy"), "same"),
        (span("yyyy年 M月 d日", " - ", "yyyy年 M月 d日"), "open"),
        (F.date_format("d", "EEE d MMM yyyy"), "same"),
        (F.date_format("d", "d MMM yyyy (EEE)"), "same"),
        (F.date_format("d", "d MMM, yyyy"), "open"),
        (span("d", "–", "d MMMM yyyy", month_end), "same"),
        (span("yyyy.MM.dd", " - ", "dd", month_end), "same"),
        (span("d MMM", " - ", "d MMM, yyyy", year_end), "open"),
        (F.concat(F.lit("From "), F.date_format("d", "yyyy-MM-dd")), "open"),
        (F.concat(F.lit("Until "), F.date_format("e", "yyyy-MM-dd")), "open"),
        (F.concat(F.date_format("d", "d MMM yyyy (EEE)"), F.lit(" – onward")), "same"),
        (span("d/M/yyyy", " - ", "d/M/yyyy"), "open"),
        (span("dd.MM.yyyy", " to ", "dd.MM.yyyy"), "open"),
    ]
    texts = F.array(*[F.struct(text.alias("text"), F.lit(end).alias("single_end")) for text, end in forms])
    shows = orders(spark, folder).select("k", F.posexplode(texts).alias("form", "f")).select("k", "form", "f.*")
    shows = D.with_date_range(shows, "text", W.AS_OF, F.col("single_end"))
    return shows.select("k", F.col("form").cast("long").alias("form"), day("start_date").alias("start_date"),
                        day("end_date").alias("end_date"))


@query(
    "date_month_ranges",
    f"""
    WITH o AS (
        SELECT o_orderkey AS k, {_D} AS d, {_D} + 7 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS e FROM orders
    )
    SELECT k, CAST(f AS BIGINT) AS form,
           CASE WHEN f = 3 THEN '2020-06-18' ELSE CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) END AS start_date,
           CASE f WHEN 0 THEN CAST(last_day(d) AS VARCHAR) WHEN 2 THEN CAST(CAST(e AS DATE) AS VARCHAR)
                  WHEN 4 THEN NULL ELSE CAST(last_day(CAST(e AS DATE)) AS VARCHAR) END AS end_date
    FROM o, unnest(range(0, 5)) t(f)
    """,
)
def date_month_ranges(spark: SparkSession, folder: str) -> DataFrame:
    start = F.date_format("d", "MMMM yyyy")
    forms = [
        start,
        F.concat(start, F.lit(" – "), F.date_format("e", "MMM yyyy")),
        F.concat(start, F.lit(" – "), F.date_format("e", "d MMM yyyy (EEE)")),
        F.concat(F.lit("Now – "), F.date_format("e", "MMMM yyyy")),
        F.concat(start, F.lit(" – now")),
    ]
    shows = orders(spark, folder).select("k", F.posexplode(F.array(*forms)).alias("form", "text"))
    shows = D.with_date_range(shows, "text", W.AS_OF, "same")
    return shows.select("k", F.col("form").cast("long").alias("form"), day("start_date").alias("start_date"),
                        day("end_date").alias("end_date"))


@query(
    "date_mentions",
    f"""
    WITH o AS (
        SELECT o_orderkey AS k, o_orderstatus AS s, {_D} AS d,
               CAST({_D} + 7 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DATE) AS e FROM orders
    ), m AS (
        SELECT *, CASE WHEN s = 'F' THEN 2019 ELSE 2020 END AS y FROM o
    ), p AS (
        SELECT k, d, e, last_day(d) AS l, TRY_CAST(y || strftime(d, '-%m-%d') AS DATE) AS dy,
               TRY_CAST(y || strftime(e, '-%m-%d') AS DATE) AS ey FROM m
    )
    SELECT k, CAST(f AS BIGINT) AS form,
           CAST(CASE f WHEN 0 THEN d WHEN 1 THEN d WHEN 2 THEN dy WHEN 3 THEN least(dy, ey)
                       WHEN 4 THEN CAST(date_trunc('month', d) AS DATE) END AS VARCHAR) AS start_date,
           CAST(CASE f WHEN 0 THEN e WHEN 1 THEN l
                       WHEN 3 THEN CASE WHEN dy IS NOT NULL AND ey IS NOT NULL THEN greatest(dy, ey) END END AS VARCHAR) AS end_date
    FROM p, unnest(range(0, 6)) t(f)
    """,
)
def date_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Dates in sentences: two full dates, a day range, one and two without year, a month, none."""
    forms = [
        F.concat(F.lit("From "), F.date_format("d", "d MMMM yyyy"), F.lit(" and until "), F.date_format("e", "d MMM yyyy")),
        F.concat(F.lit("Open "), F.date_format("d", "d"), F.lit("-"), F.date_format(F.last_day("d"), "d MMM, yyyy"), F.lit(".")),
        F.concat(F.lit("On "), F.date_format("d", "d"), F.lit("th "), F.date_format("d", "MMM")),
        F.concat(F.lit("On "), F.date_format("d", "d MMMM"), F.lit(" or "), F.date_format("e", "d MMMM")),
        F.concat(F.lit("All of "), F.date_format("d", "MMMM yyyy")),
        F.lit("Maybe at the Market"),
    ]
    url = F.when(F.col("s") == "F", F.lit("/en/2019/a")).otherwise(F.lit("/en/1999/a"))
    shows = orders(spark, folder).select("k", url.alias("url"), F.posexplode(F.array(*forms)).alias("form", "text"))
    shows = D.with_mentioned_dates(shows, "text", "url", W.AS_OF)
    return shows.select("k", F.col("form").cast("long").alias("form"), day("start_date").alias("start_date"),
                        day("end_date").alias("end_date"))


@query(
    "weekday_strip",
    f"""
    SELECT o_orderkey AS k, strftime({_D}, '%-d %b %Y') AS bracketed, strftime({_D}, '%-d %b %Y') AS leading,
           strftime({_D}, '%-d/%-m') AS short, CAST({_D} AS VARCHAR) AS date
    FROM orders
    """,
)
def weekday_strip(spark: SparkSession, folder: str) -> DataFrame:
    shows = orders(spark, folder).select(
        "k",
        D.without_weekday(F.date_format("d", "d MMM yyyy (EEE)")).alias("bracketed"),
        D.without_weekday(F.date_format("d", "EEEE, d MMM yyyy")).alias("leading"),
        D.without_weekday(F.date_format("d", "d/M (EEE)")).alias("short"),
    )
    return shows.withColumn("date", day(D.parse_date(F.col("leading"))))


# ---------------------------------------------------------------- languages, classes, records


def half_rows(df: DataFrame, **values: Column) -> DataFrame:
    """Half records from columns; what is not given is NULL."""
    values = {"fetched_at": F.lit(W.FETCHED).cast("timestamp"), "pos": F.lit(0), "source": F.lit("x"), **values}
    columns = [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in HALF_FIELDS.items()]
    rest = ("source", "lang", "page_id", "pos", "fetched_at", "link_key", "hop")
    return df.select(*[values[name].alias(name) for name in rest], *columns)


def _page_sides(spark: SparkSession, folder: str) -> DataFrame:
    """An English half per order and a Chinese one unless it is pending, from each address."""
    shows = orders(spark, folder)
    key = F.concat(F.lit("https://venue.example/zh/"), "k")
    address = F.concat(F.lit("https://venue.example/en/"), "k")
    english = half_rows(
        shows, lang=F.lit("en"), hop=F.lit(0), page_id=F.col("k"), link_key=bilingual.twin_url(address, "/en/", "/zh/"),
        event_name_eng=F.concat(F.lit("Show "), "k"), start_date=F.col("d"), link_eng=address,
        fee=F.when(F.col("s") == "F", F.concat(F.lit("$"), "price")),
        location_eng=F.when(F.col("n") == 1, F.concat(F.lit("Hall "), "c")),
    )
    chinese = half_rows(
        shows.where("s <> 'P'"), lang=F.lit("zh"), hop=F.lit(1), page_id=F.col("k"), link_key=key, link_chi=key,
        event_name_chi=F.concat(F.lit("節目"), "k"), location_chi=F.when(F.col("n") == 2, F.concat("c", F.lit("號廳"))),
    )
    return english.unionByName(chinese)


@query(
    "bilingual_pair",
    """
    SELECT sha256('x|https://venue.example/zh/' || o_orderkey) AS event_id, 'Show ' || o_orderkey AS event_name_eng,
           CASE WHEN o_orderstatus <> 'P' THEN '節目' || o_orderkey END AS event_name_chi,
           strftime(o_orderdate, '%Y-%m-%d') AS start_date, 'https://venue.example/en/' || o_orderkey AS link_eng,
           CASE WHEN o_orderstatus <> 'P' THEN 'https://venue.example/zh/' || o_orderkey END AS link_chi
    FROM orders
    """,
)
def bilingual_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Every page fetched twice: copies must not multiply the records."""
    sides = _page_sides(spark, folder)
    paired = bilingual.pair_languages(sides.unionByName(sides))
    return paired.select("event_id", "event_name_eng", "event_name_chi", day("start_date").alias("start_date"),
                         "link_eng", "link_chi")


@query(
    "bilingual_merge",
    """
    WITH en AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderdate AS d FROM orders WHERE o_orderstatus <> 'F'),
         zh AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderdate AS d FROM orders WHERE o_orderstatus <> 'O')
    SELECT 'show-' || coalesce(en.id, zh.id) AS event_id, 'First ' || en.c AS event_name_eng, '後' || zh.c AS event_name_chi,
           strftime(coalesce(en.d, zh.d), '%Y-%m-%d') AS start_date
    FROM en FULL OUTER JOIN zh ON en.id = zh.id
    """,
)
def bilingual_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Every entry twice: the first English and the last Chinese one count, dates are of the first."""
    shows = orders(spark, folder)

    def entries(df: DataFrame, lang: str, page: int, **values: Column) -> DataFrame:
        key = F.concat(F.lit("show-"), "k")
        return half_rows(df, lang=F.lit(lang), hop=F.lit(0 if lang == "en" else 1), page_id=F.lit(page), link_key=key, **values)

    english, chinese = shows.where("s <> 'F'"), shows.where("s <> 'O'")
    parts = [
        entries(english, "en", 2, event_name_eng=F.concat(F.lit("Second "), "c"), start_date=F.col("e")),
        entries(english, "en", 1, event_name_eng=F.concat(F.lit("First "), "c"), start_date=F.col("d")),
        entries(chinese, "zh", 4, event_name_chi=F.concat(F.lit("後"), "c"), start_date=F.col("e")),
        entries(chinese, "zh", 3, event_name_chi=F.concat(F.lit("前"), "c"), start_date=F.col("d")),
    ]
    merged = bilingual.merge_languages(records.union_sources(parts))
    return merged.select("event_id", "event_name_eng", "event_name_chi", day("start_date").alias("start_date"))


@query(
    "fee_lookup",
    """
    SELECT 'https://venue.example/zh/' || o_orderkey || '/page.html' AS link_chi,
           CASE WHEN o_orderstatus = 'F' THEN '$' || CAST(floor(o_totalprice) AS BIGINT)
                WHEN o_orderstatus = 'O' THEN '$1' || o_custkey END AS fee
    FROM orders
    """,
)
def fee_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The page's own fee, else the ticket page's (fetched twice, the first counts), else none."""
    shows = orders(spark, folder)
    events = shows.select(
        F.concat(F.lit("id-"), "k").alias("event_id"),
        F.concat(F.lit("https://venue.example/zh/"), "k", F.lit("/page.html")).alias("link_chi"),
        F.when(F.col("s") == "F", F.concat(F.lit("$"), "price")).alias("fee"),
    )
    page = W.template('<div id="article"><p>Tickets</p><p><span> — <strong>票價：$1{c}</strong></span></p></div>', c=F.col("c"))
    first = shows.where("s <> 'P'").select(
        F.concat(F.lit("https://venue.example/zh/"), "k", F.lit("/ticketinfo.html")).alias("url"),
        page.alias("html"), F.lit(W.FETCHED).cast("timestamp").alias("fetched_at"), F.lit(1).alias("page_id"),
    )
    again = first.withColumns({"html": F.replace("html", F.lit("$1"), F.lit("$9")), "page_id": F.lit(2)})
    fees = first.unionByName(again).withColumn("fee", bilingual.fee_of_ticket_page(F.col("html")))
    return bilingual.lookup_fees(events, fees.drop("html")).select("link_chi", "fee")


@query(
    "fill_location",
    """
    SELECT o_orderkey AS k, coalesce(en, zh) AS location_eng, coalesce(zh, en) AS location_chi
    FROM (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'Hall ' || o_custkey END AS en,
                 CASE WHEN o_orderpriority LIKE '2%' AND o_orderstatus <> 'P' THEN o_custkey || '號廳' END AS zh
          FROM orders)
    """,
)
def fill_location(spark: SparkSession, folder: str) -> DataFrame:
    paired = bilingual.pair_languages(_page_sides(spark, folder))
    key = F.regexp_extract("link_eng", "([0-9]+)$", 1).cast("long")
    return bilingual.fill_location(paired).select(key.alias("k"), "location_eng", "location_chi")


@query(
    "classify_type",
    """
    WITH rules(priority, type_eng, type_chi, keyword) AS (
        VALUES (1, 'Colour', '顏色', 'red'), (1, 'Colour', '顏色', 'blue'), (2, 'Size', '大小', 'small'),
               (2, 'Size', '大小', 'large'), (3, 'Thing', '物件', 'bolt'), (3, 'Thing', '物件', 'gear')
    ), hits AS (
        SELECT p_partkey, arg_max(type_eng, priority) AS type_eng, arg_max(type_chi, priority) AS type_chi
        FROM part JOIN rules ON contains(lower(p_name), keyword) GROUP BY p_partkey
    )
    SELECT p.p_partkey, coalesce(type_eng, 'Other') AS type_eng, type_chi FROM part p LEFT JOIN hits USING (p_partkey)
    """,
)
def classify_type(spark: SparkSession, folder: str) -> DataFrame:
    rules = (
        classify.TypeRule("Colour", "顏色", ("red", "blue")),
        classify.TypeRule("Size", "大小", ("small", "large")),
        classify.TypeRule("Thing", "物件", ("bolt", "gear")),
    )
    kind = F.coalesce(classify.classify(F.initcap("p_name"), rules), F.lit("Other"))
    parts = table(spark, folder, "part").select("p_partkey", kind.alias("type_eng"))
    return parts.withColumn("type_chi", classify.translate_type(F.col("type_eng"), rules))


_TITLE = "concat('Evening for Customer#', lpad(cast(o_custkey AS string), 9, '0'), ' ', o_orderpriority)"


@query(
    "classify_by_table",
    """
    WITH rules AS (
        SELECT c_custkey AS rule_no, c_mktsegment AS type_eng, 'c' || c_nationkey AS type_chi, lower(c_name) AS keyword
        FROM customer WHERE c_nationkey % 3 = 0
        UNION ALL
        SELECT 100000000 + n_nationkey, n_name, 'n' || n_regionkey, n_nationkey || ' 1-urgent' FROM nation
    ), titles AS (
        SELECT o_orderkey, 'Evening for Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' ' || o_orderpriority AS title FROM orders
    ), hits AS (
        SELECT title, arg_max(type_eng, rule_no) AS type_eng, arg_max(type_chi, rule_no) AS type_chi
        FROM (SELECT DISTINCT title FROM titles) t JOIN rules ON contains(lower(title), keyword) GROUP BY title
    )
    SELECT o_orderkey, type_eng, type_chi FROM titles LEFT JOIN hits USING (title)
    """,
)
def classify_by_table(spark: SparkSession, folder: str) -> DataFrame:
    """Event classes by rules in a table, one or more for each customer and nation."""
    customers = table(spark, folder, "customer").where("c_nationkey % 3 = 0")
    nations = table(spark, folder, "nation")
    rules = customers.selectExpr("c_custkey AS rule_no", "c_mktsegment AS type_eng", "concat('c', c_nationkey) AS type_chi", "lower(c_name) AS keyword").unionByName(
        nations.selectExpr("100000000 + n_nationkey AS rule_no", "n_name AS type_eng", "concat('n', n_regionkey) AS type_chi", "concat(n_nationkey, ' 1-urgent') AS keyword"))
    titles = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_TITLE} AS title")
    return titles.join(rule_tables.classify_by_table(titles, rules), "title", "left").select("o_orderkey", "type_eng", "type_chi")


@query(
    "labels_by_table",
    """
    WITH tokens AS (
        SELECT doc_id, source, unnest(string_split(text, ' ')) AS token, unnest(range(len(string_split(text, ' ')))) AS place
        FROM documents
    ), rules AS (
        SELECT source, lower(token) AS alias, min(doc_id) AS rank, 'f' || min(doc_id) % 5 AS field FROM tokens
        WHERE place = 0 AND token <> '' GROUP BY source, lower(token)
    ), pairs AS (
        SELECT doc_id, source, lower(token) AS alias, place, lead(token) OVER (PARTITION BY doc_id ORDER BY place) AS value FROM tokens
    ), firsts AS (
        SELECT doc_id, field, alias, rank, arg_min(coalesce('=' || value, '-'), place) AS value
        FROM pairs JOIN rules USING (source, alias) GROUP BY doc_id, field, alias, rank
    )
    SELECT doc_id, field, arg_max(substr(value, 2), rank) AS value FROM firsts WHERE value <> '-' GROUP BY doc_id, field
    """,
)
def labels_by_table(spark: SparkSession, folder: str) -> DataFrame:
    """Values behind labels, with a label table made of the first words of each source's documents."""
    docs = table(spark, folder, "documents").select("doc_id", "source", F.split("text", " ").alias("tokens"))
    labels = docs.select("source", F.lower(F.get("tokens", F.lit(0))).alias("alias"), "doc_id").where("alias <> ''")
    rules = labels.groupBy("source", "alias").agg(F.min("doc_id").alias("rank"))
    rules = rules.withColumn("field", F.concat(F.lit("f"), (F.col("rank") % 5).cast("string")))
    return rule_tables.labels_by_table(docs, rules, ("doc_id",))


@query(
    "conform_union",
    """
    SELECT 'p' || page_id AS event_id, regexp_extract(html, '<title>([^<]*)', 1) AS event_name_eng,
           CAST(NULL AS VARCHAR) AS event_name_chi, 'Online' AS location_eng, 'Free admission' AS fee,
           'Asia Society' AS source, url AS link_eng FROM pages
    UNION ALL
    SELECT 'd' || doc_id, NULL, text, 'Online', NULL, 'HKTDC', NULL FROM documents
    """,
)
def conform_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources with different columns in one record form, each with its own defaults."""
    one = table(spark, folder, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("event_id"), F.lit(R.ASIA_SOCIETY).alias("source"),
        H.first_group(F.col("html"), "<title>([^<]*)").alias("event_name_eng"), F.col("url").alias("link_eng"),
    )
    two = table(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("event_id"), F.lit(R.TRADE_COUNCIL).alias("source"),
        F.col("text").alias("event_name_chi"),
    )
    conformed = records.conform(records.union_sources([one, two]), R.DEFAULTS)
    return conformed.select("event_id", "event_name_eng", "event_name_chi", "location_eng", "fee", "source", "link_eng")


@query(
    "drop_transport",
    """
    SELECT o_orderkey AS event_id, o_orderstatus AS source FROM orders
    """,
)
def drop_transport(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("source"),
        F.col("o_custkey").alias("depth"), F.col("o_totalprice").alias("download_latency"),
    )
    return records.drop_transport(rows)


# ---------------------------------------------------------------- store and stream


def _stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the ``events`` table in the store's form, one id per user and kind."""
    return table(spark, folder, "events").select(
        F.concat_ws("-", "user_id", "event_type").alias("event_id"),
        F.col("event_type").alias("source"),
        F.col("ts").cast("timestamp").alias("fetch_date"),
        F.col("value").cast("string").alias("fee"),
        F.col("event_id").alias("row_id"),
    )


@query(
    "append_new",
    """
    WITH ids AS (
        SELECT user_id || '-' || event_type AS event_id, event_type AS source, row_number() OVER (
                   PARTITION BY user_id, event_type
                   ORDER BY CASE WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 0 ELSE 1 END,
                            ts, event_id) AS rn, event_id AS row_id
        FROM events
    )
    SELECT event_id, source, row_id FROM ids WHERE rn = 1
    """,
)
def append_new(spark: SparkSession, folder: str) -> DataFrame:
    """The earlier half of the events, then all of them, then all again: only new ids are added."""
    rows, store = _stored_rows(spark, folder), scratch_dir(spark, "store")
    bounds = rows.select(F.unix_micros("fetch_date").alias("t")).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    middle = F.timestamp_micros(F.lit(bounds.lo + (bounds.hi - bounds.lo) // 2))
    order = ("fetch_date", "row_id")
    S.append_new(rows.where(F.col("fetch_date") < middle), store, order)
    S.append_new(rows, store, order)
    S.append_new(rows, store, order)
    return S.find_events(spark, store, ["event_id", "source", "row_id"])


@query(
    "find_projection",
    """
    SELECT event_id AS row_id, user_id || '-' || event_type AS event_id FROM events WHERE event_type = 'click' AND value > 50
    """,
)
def find_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Append, then find with a condition on the partition and one on a column."""
    store = scratch_dir(spark, "store")
    S.append_events(_stored_rows(spark, folder).withColumn("value", F.col("fee").cast("double")), store)
    return S.find_events(spark, store, ["row_id", "event_id"], "source = 'click' and value > 50")


# ---------------------------------------------------------------- venues, end to end


def shown(events: DataFrame) -> DataFrame:
    """Event records with every column as text."""
    return events.select(
        "event_id",
        "source",
        *TEXT_FIELDS,
        day("start_date").alias("start_date"),
        day("end_date").alias("end_date"),
        F.array_join(F.transform("dates", lambda d: d.cast("string")), ",").alias("dates"),
        F.date_format("fetch_date", "yyyy-MM-dd HH:mm:ss").alias("fetch_date"),
        F.col("fee_amount").cast("string").alias("fee_amount"),
        F.col("extract_ok").cast("string").alias("extract_ok"),
    )


_ROWS = """
    WITH o AS (
        SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS n, o_orderstatus AS s,
               CAST(floor(o_totalprice) AS BIGINT) AS price
        FROM orders
    ), r AS (
        SELECT *, CAST(d + 7 * n AS DATE) AS e, s <> 'P' AS twin, CAST(last_day(d) AS DATE) AS l FROM o
    )
"""
_AMOUNT = "CAST(CAST(price AS DECIMAL(10, 2)) AS VARCHAR)"


def expected(source: str, rows: str, given: dict[str, str], test: str = "true") -> str:
    """Select of the record columns, NULL where nothing is expected."""
    names = ("event_id", "source", *TEXT_FIELDS, "start_date", "end_date", "dates", "fetch_date", "fee_amount", "extract_ok")
    values = {"source": f"'{source}'", "fetch_date": f"'{W.FETCHED}'", "extract_ok": "'true'", **given}
    columns = ", ".join(f"CAST({values.get(name, 'NULL')} AS VARCHAR) AS {name}" for name in names)
    return f"SELECT {columns} FROM {rows} WHERE ({test})"


def _hash(source: str, key: str) -> str:
    return f"sha256('{source}|' || {key})"


def _named(chi: str = "twin") -> dict[str, str]:
    return {
        "event_name_eng": "'Show ' || k",
        "event_name_chi": f"CASE WHEN {chi} THEN '節目' || k END",
        "location_eng": "'Hall ' || c",
        "location_chi": f"CASE WHEN {chi} THEN c || '號廳' END",
    }


def _linked(source: str, english: str, chinese: str, key: str = "chinese") -> dict[str, str]:
    return {
        "event_id": _hash(source, chinese if key == "chinese" else english),
        "link_eng": english if key == "chinese" else f"CASE WHEN twin THEN {english} END",
        "link_chi": f"CASE WHEN twin THEN {chinese} END" if key == "chinese" else chinese,
    }


_OPEN = {"start_date": "d", "end_date": "CASE WHEN n > 1 THEN e END"}
_SAME = {"start_date": "d", "end_date": "CASE WHEN n > 1 THEN e ELSE d END"}
_LETTERS = "translate(CAST(k AS VARCHAR), '0123456789', 'abcdefghij')"
_TOLD = (
    "(CASE n WHEN 1 THEN 'Open on ' || strftime(d, '%-d %B %Y') WHEN 2 THEN 'Open ' || day(d) || ' - ' || strftime(l, '%-d %b, %Y') "
    "WHEN 3 THEN 'From ' || day(d) || 'th ' || strftime(d, '%B') WHEN 4 THEN strftime(d, '%B %Y') || ' and ' || strftime(e, '%-d %b %Y') "
    "ELSE 'Maybe at the Market' END || '.' || CASE WHEN s = 'F' THEN 'In 2019.' ELSE '' END || 'Bye & see')"
)
_YEARLESS = "TRY_CAST((CASE WHEN s = 'F' THEN '2019' ELSE '2020' END) || strftime(d, '-%m-%d') AS DATE)"
_IN_2020 = "CAST('2020' || strftime({}, '-%m-%d') AS DATE)"
_FILM_DATES = (
    f"CASE n WHEN 3 THEN d || ',' || e WHEN 4 THEN least({_IN_2020.format('d')}, {_IN_2020.format('e')}) || ',' || "
    f"greatest({_IN_2020.format('d')}, {_IN_2020.format('e')}) END"
)
_FILM_EN = "CASE WHEN n = 5 THEN 'https://goethe.example/en/show/' ELSE 'http://film.example/en_US/web/' END || k || '/page.html'"
_FILM_ZH = "CASE WHEN n = 5 THEN 'https://goethe.example/cn/show/' ELSE 'http://film.example/zh_TW/web/' END || k || '/page.html'"
_MILLS_PLACE, _MILLS_PLACE_ZH = "' Venue: Hall ' || c", "'地點：廳' || c"
_NL = "chr(10)"

EXPECTED: dict[str, Callable[[str], str]] = {
    R.WEST_KOWLOON: lambda test: expected(R.WEST_KOWLOON, "r", {
        **_named(), **_OPEN, **_linked(R.WEST_KOWLOON, "'https://west.example/en/show/' || k", "'https://west.example/tc/show/' || k"),
        "location_eng": "c || ' Hall'",
        "description_eng": "'About ' || k || ' & more'",
        "description_chi": "CASE WHEN twin THEN '關於 ' || k || ' & more' END",
        "fee": "CASE WHEN s = 'F' THEN ' for all' ELSE ' $' || price || ' & up' END",
        "fee_amount": f"CASE WHEN s <> 'F' THEN {_AMOUNT} END",
    }, test),
    R.TAI_KWUN: lambda test: expected(R.TAI_KWUN, "r", {
        **_named(), **_OPEN, **_linked(R.TAI_KWUN, "'https://kwun.example/en/programme/' || k", "'https://kwun.example/zh/programme/' || k"),
        "description_eng": "'About ' || k || 'R&D'",
        "description_chi": "CASE WHEN twin THEN '關於' || k || 'R&D' END",
        "fee": "'$' || price || ' each'",
        "fee_amount": _AMOUNT,
    }, test),
    R.TOURISM_BOARD: lambda test: expected(R.TOURISM_BOARD, "r", {
        **_named(), **_SAME, **_linked(R.TOURISM_BOARD, "'https://tour.example/us/events/' || k || '.html'", "'https://tour.example/tc/events/' || k || '.html'"),
        "description_eng": "'About ' || k",
        "description_chi": "CASE WHEN twin THEN '關於' || k END",
        "event_type_eng": "'Music'",
        "event_type_chi": "CASE WHEN twin THEN 'Music' END",
        "organiser_eng": "'Club ' || c || ' & co'",
        "organiser_chi": "CASE WHEN twin THEN '會' || c || ' & co' END",
        "fee": "CASE WHEN s <> 'F' THEN '$' || price END",
        "fee_amount": f"CASE WHEN s <> 'F' THEN {_AMOUNT} END",
    }, test),
    R.TRADE_COUNCIL: lambda test: expected(R.TRADE_COUNCIL, "r", {
        **_linked(R.TRADE_COUNCIL, "'http://trade.example/en/fair/' || k", "'http://trade.example/tc/fair/' || k", "english"),
        "event_name_eng": "CASE WHEN twin THEN 'Show ' || k END",
        "event_name_chi": "'節目' || k",
        "start_date": "CASE WHEN twin THEN d END",
        "end_date": "CASE WHEN twin THEN d END",
        "description_eng": "CASE WHEN twin THEN 'About ' || k END",
        "description_chi": "'關於' || k",
        "event_type_eng": "CASE WHEN twin THEN 'Webinar' END",
        "event_type_chi": "'網上'",
        "location_eng": "'Online'",
        "location_chi": "'網上直播'",
        "organiser_eng": "CASE WHEN twin THEN 'Club ' || c END",
        "organiser_chi": "'會' || c",
        "fee": "CASE WHEN s = 'O' THEN 'HK$' || price END",
        "fee_amount": f"CASE WHEN s = 'O' THEN {_AMOUNT} END",
    }, test),
    R.PMQ: lambda test: expected(R.PMQ, "r", {
        **_linked(R.PMQ, "'https://pmq.example/programme/' || k || '/?lang=en'", "'https://pmq.example/programme/' || k || '/?lang=ch'", "english"),
        "event_name_eng": "CASE WHEN twin THEN 'Show ' || k END",
        "event_name_chi": "'節目' || k",
        "start_date": "CASE WHEN twin THEN CASE WHEN n <= 2 THEN CAST(date_trunc('month', d) AS DATE) WHEN n = 4 THEN DATE '2020-06-18' ELSE d END END",
        "end_date": "CASE WHEN twin THEN CASE n WHEN 1 THEN l WHEN 3 THEN e WHEN 5 THEN NULL ELSE last_day(e) END END",
        "description_eng": f"CASE WHEN twin THEN 'About ' || k || {_NL} || 'See you' END",
        "description_chi": f"'關於' || k || {_NL} || '再見'",
        "event_type_eng": "CASE WHEN s = 'O' THEN 'Talk' END",
        "event_type_chi": "CASE WHEN s <> 'F' THEN '講座' END",
        "location_eng": "CASE WHEN twin THEN 'Hall ' || c END",
        "location_chi": "c || '號廳'",
        "organiser_eng": "CASE WHEN twin THEN 'Club ' || c END",
        "organiser_chi": "'會' || c",
        "fee": "CASE WHEN twin THEN '$' || price END",
        "fee_amount": f"CASE WHEN twin THEN {_AMOUNT} END",
    }, test),
    R.MUSEUM_OF_ART: lambda test: expected(R.MUSEUM_OF_ART, "r", {
        **_named(), **_linked(R.MUSEUM_OF_ART, "'http://museum.example/en_US/web/ma/' || k || '.html'", "'http://museum.example/zh_TW/web/ma/' || k || '.html'"),
        "start_date": "CASE WHEN n = 2 THEN DATE '2020-06-18' ELSE d END",
        "end_date": "CASE WHEN n > 1 THEN e END",
        "description_eng": "'About ' || k",
        "description_chi": "CASE WHEN twin THEN '關於' || k END",
        "fee": "'$' || price",
        "fee_amount": _AMOUNT,
    }, test),
    R.TAIKOO: lambda test: expected(R.TAIKOO, "r", {
        **_named(), **_linked(R.TAIKOO, f"'http://taikoo.example/en/whatson/' || {_LETTERS}", f"'http://taikoo.example/zh-hk/whatson/' || {_LETTERS}"),
        "start_date": f"CASE n WHEN 1 THEN d WHEN 2 THEN d WHEN 3 THEN {_YEARLESS} WHEN 4 THEN CAST(date_trunc('month', d) AS DATE) END",
        "end_date": "CASE n WHEN 2 THEN l WHEN 4 THEN e END",
        "description_eng": _TOLD,
        "description_chi": f"CASE WHEN twin THEN {_TOLD} END",
        "location_eng": "CASE WHEN s <> 'F' THEN 'Hall ' || c END",
        "location_chi": "CASE WHEN s = 'O' THEN c || '號廳' END",
        "fee": "CASE s WHEN 'F' THEN 'Free entry' WHEN 'O' THEN '$' || price END",
        "fee_amount": f"CASE WHEN s = 'O' THEN {_AMOUNT} END",
    }, test),
    R.THE_MILLS: lambda test: expected(R.THE_MILLS, "(SELECT * REPLACE (twin AND n <= 3 AS twin) FROM r)", {
        **_SAME, **_linked(R.THE_MILLS, "'http://mills.example/en/event/' || k", "'http://mills.example/ch/event/' || k"),
        "event_name_eng": "CASE n WHEN 1 THEN 'Concert and Workshop ' WHEN 2 THEN 'Big Exhibition ' WHEN 3 THEN 'Market day ' ELSE 'DIY Sale ' END || k",
        "event_name_chi": "CASE WHEN twin THEN '節目' || k END",
        "description_eng": f"CASE WHEN s = 'F' THEN 'Extra line' || {_NL} ELSE '' END || 'About ' || k || {_NL} || "
                           f"CASE WHEN n <> 2 THEN 'Come. Venue: Hall ' || c || '! Soon' || {_NL} ELSE '' END || "
                           f"CASE WHEN s = 'F' THEN 'Only $5.50' || {_NL} || '$10' || {_NL} ELSE 'Fee $' || price || {_NL} END",
        "description_chi": f"CASE WHEN twin THEN '關於' || k || {_NL} || CASE WHEN n <> 1 THEN {_MILLS_PLACE_ZH} || {_NL} ELSE '' END END",
        "event_type_eng": "CASE n WHEN 1 THEN 'Workshop' WHEN 2 THEN 'Exhibition' WHEN 4 THEN 'Sale' END",
        "event_type_chi": "CASE WHEN twin THEN CASE n WHEN 1 THEN '工作坊' WHEN 2 THEN '展覽' END END",
        "location_eng": f"CASE WHEN n <> 2 THEN {_MILLS_PLACE} WHEN twin THEN {_MILLS_PLACE_ZH} END",
        "location_chi": f"CASE WHEN twin THEN CASE WHEN n <> 1 THEN {_MILLS_PLACE_ZH} ELSE {_MILLS_PLACE} END END",
        "organiser_eng": "'Club ' || c",
        "organiser_chi": "CASE WHEN twin THEN '會' || c END",
        "fee": "CASE WHEN s = 'F' THEN 'Free admission' ELSE 'Fee $' || price END",
        "fee_amount": f"CASE WHEN s <> 'F' THEN {_AMOUNT} END",
    }, f"n < 5 AND ({test})"),
    R.FILM_ARCHIVE: lambda test: expected(R.FILM_ARCHIVE, "r", {
        **_named(), **_linked(R.FILM_ARCHIVE, _FILM_EN, _FILM_ZH),
        "start_date": f"CASE WHEN n = 4 THEN least({_IN_2020.format('d')}, {_IN_2020.format('e')}) ELSE d END",
        "end_date": "CASE WHEN n = 1 THEN e END",
        "dates": _FILM_DATES,
        "description_eng": "'About ' || k || 'More & more'",
        "description_chi": "CASE WHEN twin THEN '關於' || k || 'More & more' END",
        "fee": "CASE WHEN twin THEN CASE WHEN n > 2 THEN '$' || price WHEN s = 'F' THEN 'Free Admission' ELSE '票價 $' || price END END",
        "fee_amount": f"CASE WHEN twin AND (n > 2 OR s <> 'F') THEN {_AMOUNT} END",
    }, test),
    R.ASIA_SOCIETY: lambda test: expected(R.ASIA_SOCIETY, "(SELECT *, unnest(range(1, n + 1)) AS i FROM r)", {
        "event_id": _hash(R.ASIA_SOCIETY, "'https://asiasociety.org/hong-kong/events/' || k || '-' || i"),
        "event_name_eng": "CASE i WHEN 1 THEN '[Online] Club ' || c || ' @ Chat & Tea' WHEN 2 THEN 'Workshop on jade' WHEN 3 THEN 'Garden party' "
                          "WHEN 4 THEN 'Performance and DIY' ELSE 'The Collection' END",
        "start_date": "CAST(d + CAST(7 * i AS INTEGER) AS DATE)",
        "end_date": "CAST(d + CAST(7 * i AS INTEGER) AS DATE)",
        "description_eng": "'About ' || k || ' & more'",
        "event_type_eng": "CASE i WHEN 1 THEN 'Conversation' WHEN 2 THEN 'Workshop' WHEN 3 THEN 'Conversation / Others' WHEN 4 THEN 'Workshop' ELSE 'Collection' END",
        "location_eng": "'Online'",
        "fee": "CASE i WHEN 2 THEN 'Cost $' || price || ' each' ELSE 'Free admission' END",
        "fee_amount": f"CASE i WHEN 2 THEN {_AMOUNT} END",
        "organiser_eng": "CASE i WHEN 1 THEN 'Club ' || c ELSE 'Asia Society Hong Kong Center' END",
        "link_eng": "'https://asiasociety.org/hong-kong/events/' || k || '-' || i",
    }, test),
    R.ASIA_WORLD_EXPO: lambda test: expected(R.ASIA_WORLD_EXPO, "(SELECT *, unnest(range(1, n + 1)) AS i FROM r)", {
        "event_id": "'show-' || k || '-' || i || '-' || year(d)",
        "event_name_eng": "CASE WHEN s <> 'F' THEN 'Show ' || k || '/' || i END",
        "event_name_chi": "CASE WHEN s <> 'O' THEN '節目' || k || '/' || i END",
        "start_date": "d",
        "end_date": "CASE WHEN i > 1 THEN l END",
        "description_eng": "CASE WHEN s <> 'F' THEN 'About ' || k || '  more' END",
        "description_chi": "CASE WHEN s <> 'O' THEN '關於' || k || '  more' END",
        "location_eng": "CASE WHEN s <> 'F' THEN 'Hall ' || c END",
        "location_chi": "CASE WHEN s <> 'O' THEN c || '號廳' END",
        "organiser_eng": "CASE WHEN s <> 'F' THEN 'Club ' || c || ' & co' END",
        "organiser_chi": "CASE WHEN s <> 'O' THEN '會' || c || ' & co' END",
        "link_eng": "CASE WHEN s <> 'F' THEN 'http://expo.example/events/' || k END",
        "link_chi": "CASE WHEN s <> 'O' THEN 'https://expo.example/zh-tc/events/' || k END",
    }, test),
}

VENUE_QUERIES = {
    "venue_asia_society": R.ASIA_SOCIETY,
    "venue_asia_world_expo": R.ASIA_WORLD_EXPO,
    "venue_film_archive": R.FILM_ARCHIVE,
    "venue_museum_of_art": R.MUSEUM_OF_ART,
    "venue_tourism_board": R.TOURISM_BOARD,
    "venue_trade_council": R.TRADE_COUNCIL,
    "venue_pmq": R.PMQ,
    "venue_taikoo_place": R.TAIKOO,
    "venue_tai_kwun": R.TAI_KWUN,
    "venue_the_mills": R.THE_MILLS,
    "venue_west_kowloon": R.WEST_KOWLOON,
}


def _venue_query(source: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        pages = W.RENDER[source](orders(spark, folder))
        return shown(venues.extract_events(pages, W.AS_OF, [source]))

    return run


for _name, _source in VENUE_QUERIES.items():
    query(_name, _ROWS + EXPECTED[_source]("true"))(_venue_query(_source))


# Which venue's page an order becomes when all venues run together: every order becomes one.
SHARES = {
    R.WEST_KOWLOON: "(n = 1 AND s = 'O') OR (n = 4 AND s = 'P')",
    R.TAI_KWUN: "(n = 1 AND s = 'F') OR (n = 5 AND s = 'F')",
    R.TOURISM_BOARD: "n = 1 AND s = 'P'",
    R.ASIA_SOCIETY: "n = 2 AND s = 'O'",
    R.ASIA_WORLD_EXPO: "(n = 2 AND s = 'F') OR (n = 5 AND s = 'P')",
    R.FILM_ARCHIVE: "(n = 2 AND s = 'P') OR (n = 5 AND s = 'O')",
    R.TRADE_COUNCIL: "n = 3 AND s = 'O'",
    R.PMQ: "n = 3 AND s = 'F'",
    R.MUSEUM_OF_ART: "n = 3 AND s = 'P'",
    R.TAIKOO: "n = 4 AND s = 'O'",
    R.THE_MILLS: "n = 4 AND s = 'F'",
}


def all_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page table of all venues."""
    shows = orders(spark, folder)
    return records.union_sources([W.RENDER[source](shows.where(test)) for source, test in SHARES.items()])


@query("all_venues", _ROWS + " UNION ALL ".join(EXPECTED[source](test) for source, test in SHARES.items()))
def all_venues(spark: SparkSession, folder: str) -> DataFrame:
    """All venues from one stored page table, partitioned by source and kind, to one event table."""
    return shown(venues.extract_events(stored_pages(spark, all_pages(spark, folder)), W.AS_OF))


@query("incremental_ingest", _ROWS + EXPECTED[R.WEST_KOWLOON]("true"))
def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """English pages arrive first, Chinese ones in a later batch; then all pages arrive once more."""
    pages = W.west_kowloon(orders(spark, folder))
    root = scratch_dir(spark, "stream")
    incoming, work, store = f"{root}/in", f"{root}/work", f"{root}/store"
    for lang in ("en", "zh"):
        P.store_pages(pages.where(F.col("lang") == lang), incoming)
        ingest.ingest_stream(spark, incoming, work, store, W.AS_OF, [R.WEST_KOWLOON])
    P.store_pages(pages, incoming)
    ingest.ingest_stream(spark, incoming, work, store, W.AS_OF, [R.WEST_KOWLOON])
    return shown(S.find_events(spark, store))


LATE = (R.WEST_KOWLOON, R.FILM_ARCHIVE, R.ASIA_WORLD_EXPO)


@query("incremental_late_pages", _ROWS + " UNION ALL ".join(EXPECTED[source](SHARES[source]) for source in LATE))
def incremental_late_pages(spark: SparkSession, folder: str) -> DataFrame:
    """English pages, then Chinese ones, then ticket pages, each in a run of its own that stores
    what it has: the later pages complete the stored events."""
    shows = orders(spark, folder)
    pages = records.union_sources([W.RENDER[source](shows.where(SHARES[source])) for source in LATE])
    root = scratch_dir(spark, "late")
    incoming, work, store = f"{root}/in", f"{root}/work", f"{root}/store"
    for part in ("page_kind <> 'fee' AND lang = 'en'", "page_kind <> 'fee' AND lang = 'zh'", "page_kind = 'fee'"):
        P.store_pages(pages.where(part), incoming)
        ingest.ingest_stream(spark, incoming, work, store, W.AS_OF, list(LATE))
    return shown(S.find_events(spark, store))


@query(
    "page_links_quoting",
    """
    SELECT o_orderkey AS page_id, CAST(i AS BIGINT) AS pos,
           CASE i WHEN 3 THEN '/d?a=1&k=' ELSE substr('/a/b/c', 2 * CAST(i AS INTEGER) + 1, 2) || '/' END || o_orderkey AS link
    FROM orders, unnest(range(4)) t(i)
    """,
)
def page_links_quoting(spark: SparkSession, folder: str) -> DataFrame:
    """Links however a page writes them: any case, any quotes or none, references in the value."""
    html = (
        "<p><A HREF='/a/{k}'>x</A> <a class=b href=/b/{k}>x</a> <a id='i' href = \"/c/{k}\">x</a>"
        "<a\nhref=\"/d?a=1&amp;k={k}\" class='z'>x</a><abbr href='no'>x</abbr></p>"
    )
    pages = orders(spark, folder).select(F.col("k").alias("page_id"), W.template(html, k=F.col("k")).alias("html"))
    return links.extract_links(pages).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query(
    "entity_text",
    """
    SELECT o_orderkey AS k,
           'A' || chr(8211) || o_orderkey || chr(160) || 'caf' || chr(233) || ' <b> & ' || chr(8217) || chr(8364) || chr(128512) || ' &nosuch; &amp;' AS text
    FROM orders
    """,
)
def entity_text(spark: SparkSession, folder: str) -> DataFrame:
    """References of every kind, decoded once."""
    html = "<i>A</i>&#8211;{k}&nbsp;caf&eacute; &lt;b&#x3e; &amp; &rsquo;&#128;&#x1F600; &nosuch; &amp;amp;"
    shown_text = X.clean_text(X.decode_references(W.template(html, k=F.col("k"))), nbsp=X.NBSP)
    return orders(spark, folder).select("k", shown_text.alias("text"))
