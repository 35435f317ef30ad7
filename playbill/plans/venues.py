"""Extraction plans of the eleven venues.

Each plan is a narrow transformation from pages to half records: no shuffle, and the HTML never
leaves its task. One aggregation then pairs the halves of all venues.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates as D
from ..functions import html as H
from ..functions import text as X
from ..functions import tokens as K
from ..operators import bilingual, classify, fields, links, records
from ..schema import HALF_FIELDS
from ..sources import pages as P
from . import rules as R

AsOf = datetime.date | Column


def _pages(pages: DataFrame, source: str, kind: str = "detail") -> DataFrame:
    """Pages of one venue with the fields of its rules."""
    mine = pages.where((F.col("source") == source) & (F.col("page_kind") == kind))
    mine = mine.withColumn("html", X.decode_page(F.col("html")))
    found = [rule for rule in R.FIELD_RULES if rule.source == source]
    return fields.extract_fields(mine, found) if found and kind == "detail" else mine


def _english(value: Column) -> Column:
    return F.when(F.col("lang") == "en", value)


def _chinese(value: Column) -> Column:
    return F.when(F.col("lang") == "zh", value)


def _halves(df: DataFrame, hop: Column, key: Column, values: dict[str, Column], pos: str | None = None) -> DataFrame:
    columns = [
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in HALF_FIELDS.items()
    ]
    # a page without an address is an event of its own, not one with all other such pages
    key = F.coalesce(key, F.concat(F.lit("page "), F.col("page_id").cast("string")))
    return df.select(
        "source", "lang", "page_id", (F.col(pos) if pos else F.lit(0)).alias("pos"), "fetched_at",
        key.alias("link_key"), hop.alias("hop"), *columns,
    )


def _two_languages(df: DataFrame, source: str, values: dict[str, Column], ok: Column) -> DataFrame:
    """Half records of a venue whose two pages differ by a part of their address."""
    venue, url = R.VENUES[source], F.col("url")
    english, chinese = F.lit(venue.english), F.lit(venue.chinese)
    if source == R.FILM_ARCHIVE:
        partner = url.contains(R.PARTNER_HOST)
        english = F.when(partner, R.PARTNER_VENUE.english).otherwise(english)
        chinese = F.when(partner, R.PARTNER_VENUE.chinese).otherwise(chinese)
    own, other = (english, chinese) if venue.first_lang == "en" else (chinese, english)
    is_first = F.col("lang") == venue.first_lang
    named = {
        "event_name_eng": _english(F.col("name")),
        "event_name_chi": _chinese(F.col("name")),
        "fetch_date": F.when(is_first, F.col("fetched_at")),
        "link_eng": _english(url),
        "link_chi": _chinese(url),
        "extract_ok": F.coalesce(ok, F.lit(False)),
    }
    key = F.when(is_first, F.replace(url, own, other)).otherwise(url)
    return _halves(df, F.when(is_first, 0).otherwise(1), key, {**named, **values})


def _dated(df: DataFrame, source: str, as_of: AsOf) -> DataFrame:
    return D.with_date_range(df, "date_text", as_of, R.VENUES[source].single_end)


def _dates() -> dict[str, Column]:
    return {"start_date": F.col("start_date"), "end_date": F.col("end_date")}


def _date_ok() -> Column:
    """Reading the date failed when there is a text and no date."""
    return F.col("date_text").isNull() | F.col("start_date").isNotNull() | F.col("end_date").isNotNull()


def west_kowloon(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.WEST_KOWLOON)
    article = F.regexp_extract("html", r"(?s)<article\b[^>]*>(.*?)</article>", 1)
    marked = X.paragraphs_with(
        H.paragraphs(article), r"(?s)<strong[^>]*>[^<]*(?:Tickets:|Fee:|Free)"
    )
    direct = F.transform(marked, lambda p: F.regexp_replace(p, r"(?s)<strong\b.*?</strong>", ""))
    df = df.withColumns(
        {
            "fee": _english(X.clean_all(direct)),
            "place": X.clean_text(F.col("location")),
            "about": X.clean_text(F.col("description")),
            "date_text": X.clean_text(F.col("date_text")),
        }
    )
    df = _dated(df, R.WEST_KOWLOON, as_of)
    return _two_languages(
        df,
        R.WEST_KOWLOON,
        {
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            "location_eng": _english(F.col("place")),
            "location_chi": _chinese(F.col("place")),
            "fee": F.col("fee"),
            **_dates(),
        },
        F.col("name").isNotNull() & _date_ok(),
    )


def tai_kwun(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.TAI_KWUN)
    # caption and value of the information blocks: the blocks are date, location, fee
    info = F.regexp_extract("html", r'(?s)id="programme-content"[^>]*>(.*?)<section\b', 1)
    values = H.all_groups(info, r"(?s)<div[^>]*>[^<]*</div>\s*<div[^>]*>\s*<div[^>]*>(.*?)</div>")
    df = df.withColumn("values", values).withColumns(
        {
            "date_text": _english(
                X.clean_text(H.first_group(F.get("values", F.lit(0)), r"<label[^>]*>([^<]*)"))
            ),
            "place": X.clean_text(F.get("values", F.lit(1))),
            "price": X.clean_text(F.get("values", F.lit(2))),
            "about": X.clean_text(F.col("description")),
        }
    )
    df = _dated(df, R.TAI_KWUN, as_of)
    return _two_languages(
        df,
        R.TAI_KWUN,
        {
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            "location_eng": _english(F.col("place")),
            "location_chi": _chinese(F.col("place")),
            "fee": _english(F.col("price")),
            **_dates(),
        },
        F.col("place").isNotNull() & F.col("price").isNotNull() & F.col("name").isNotNull() & _date_ok(),
    )


def tourism_board(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.TOURISM_BOARD)
    bodies = H.element_bodies(F.col("html"), r'<div[^>]*\bclass="cmp-text"[^>]*>')
    texts = F.flatten(F.transform(bodies, lambda body: H.paragraphs(body)))
    df = df.withColumn("body", F.array_join(texts, "<p>"))
    df = df.withColumn("tokens", K.tokens_of(F.col("body"), K.BLANKS_FIRST))
    df = df.withColumn("lowered", K.lower_tokens(F.col("tokens")))
    labels = fields.label_columns(F.col("tokens"), F.col("lowered"), R.LABEL_RULES, R.TOURISM_BOARD)
    labels["date_text"] = _english(labels["date_text"])
    df = _dated(df.withColumns(labels), R.TOURISM_BOARD, as_of)
    first = F.get("tokens", F.lit(0))
    return _two_languages(
        df,
        R.TOURISM_BOARD,
        {
            **{name: F.col(name) for name in labels if name in HALF_FIELDS},
            "description_eng": _english(first),
            "description_chi": _chinese(first),
            **_dates(),
        },
        first.isNotNull() & _date_ok(),
    )


def trade_council(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.TRADE_COUNCIL)
    bodies = H.element_bodies(
        H.drop_invisible(F.col("html")), r'<td[^>]*\bclass="background_white_padding_middle"[^>]*>', "td"
    )
    df = df.withColumn("body", F.array_join(bodies, "<td>"))
    df = df.withColumn("tokens", K.tokens_of(F.col("body"), K.BREAKS_FIRST))
    df = df.withColumn("lowered", K.lower_tokens(F.col("tokens")))
    labels = fields.label_columns(F.col("tokens"), F.col("lowered"), R.LABEL_RULES, R.TRADE_COUNCIL)
    labels["date_text"] = _english(labels["date_text"])
    df = _dated(df.withColumns(labels), R.TRADE_COUNCIL, as_of)
    return _two_languages(
        df,
        R.TRADE_COUNCIL,
        {**{name: F.col(name) for name in labels if name in HALF_FIELDS}, **_dates()},
        F.col("name").isNotNull() & _date_ok(),
    )


def pmq(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.PMQ)
    visible = H.drop_invisible(F.col("html"))
    bodies = H.element_bodies(visible, r'<div[^>]*\bclass="container"[^>]*>')
    df = df.withColumn("body", F.array_join(bodies, "<div>"))
    fields2 = H.element_bodies(
        F.col("body"), r'<div[^>]*\bclass="field2 pull-left gapPadding20 size18"[^>]*>'
    )
    texts = F.flatten(F.transform(fields2, lambda body: H.paragraphs(body)))
    df = df.withColumn("told", F.array_join(texts, "<p>"))
    df = df.withColumns(
        {
            "tokens": K.tokens_of(F.col("body"), K.HALVED_BLANKS),
            "sentences": K.tokens_of(F.col("told"), K.HALVED_BLANKS),
        }
    )
    df = df.withColumn("lowered", K.lower_tokens(F.col("tokens")))
    tokens, lowered = F.col("tokens"), F.col("lowered")
    labels = fields.label_columns(tokens, lowered, R.LABEL_RULES, R.PMQ)
    labels["date_text"] = _english(labels["date_text"])
    name_en, type_en = K.calendar_header(tokens, lowered, *R.PMQ_HEADER["en"])
    name_zh, type_zh = K.calendar_header(tokens, lowered, *R.PMQ_HEADER["zh"])
    df = df.withColumns(
        {
            **labels,
            "name": _english(name_en),
            "name_zh": _chinese(name_zh),
            "event_type_eng": _english(type_en),
            "event_type_chi": _chinese(type_zh),
            "description_eng": _english(K.take_until(F.col("sentences"), R.PMQ_SENTINEL["en"])),
            "description_chi": _chinese(K.take_until(F.col("sentences"), R.PMQ_SENTINEL["zh"])),
        }
    )
    df = df.withColumn("name", F.coalesce("name", "name_zh"))
    df = _dated(df, R.PMQ, as_of)
    names = ("event_type_eng", "event_type_chi", "description_eng", "description_chi", *labels)
    return _two_languages(
        df,
        R.PMQ,
        {**{name: F.col(name) for name in names if name in HALF_FIELDS}, **_dates()},
        (F.size("sentences") > 0) & _date_ok(),
    )


def museum_of_art(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.MUSEUM_OF_ART)
    entries = F.regexp_extract("html", r'(?s)id="single-exhibition-content".*?<ul[^>]*>(.*?)</ul>', 1)
    pieces = F.split(entries, "<div[^>]*>")
    # up to the end of each division: cut without a pattern, and in an array of their own, as cleaning
    # names its text twice
    leaves = F.transform(H.rest(pieces), lambda piece: F.substring_index(piece, "</div>", 1))
    leaves = F.transform(F.array_remove(leaves, F.lit("")), X.clean_leaf)
    df = df.withColumn("clusters", F.array_remove(leaves, F.lit("")))
    labels = fields.label_columns(F.col("clusters"), F.col("clusters"), R.LABEL_RULES, R.MUSEUM_OF_ART)
    for name in ("date_text", "location_eng", "fee"):
        labels[name] = _english(labels[name])
    labels["location_chi"] = _chinese(labels["location_chi"])
    df = df.withColumns({**labels, "about": X.clean_text(F.col("description"))})
    df = _dated(df, R.MUSEUM_OF_ART, as_of)
    return _two_languages(
        df,
        R.MUSEUM_OF_ART,
        {
            **{name: F.col(name) for name in labels if name in HALF_FIELDS},
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            **_dates(),
        },
        _date_ok(),
    )


def taikoo(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.TAIKOO)
    copy = H.element_bodies(F.col("html"), r'<div[^>]*\bclass="event-detail__copy body-copy"[^>]*>')
    about = X.joined_nodes(F.array_join(copy, "<div>"))
    # location and fee stand between the heading and the copy
    info = F.regexp_extract("html", r'(?s)</h1>(.*?)<div[^>]*\bclass="event-detail__copy', 1)
    boxes = F.transform(H.all_groups(info, r"<div[^>]*>([^<]*[^<\s][^<]*)</div>"), X.unescape)
    df = df.withColumns({"about": X.none_if(about), "boxes": boxes})
    place, price = K.place_and_fee(F.col("boxes"))
    df = df.withColumns(
        {
            "name": X.clean_text(F.col("name")),
            "place": place,
            "price": _english(price),
            "date_text": _english(F.col("about")),
        }
    )
    df = D.with_mentioned_dates(df, "date_text", "url", as_of)
    return _two_languages(
        df,
        R.TAIKOO,
        {
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            "location_eng": _english(F.col("place")),
            "location_chi": _chinese(F.col("place")),
            "fee": F.col("price"),
            **_dates(),
        },
        F.col("name").isNotNull(),
    )


def the_mills(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.THE_MILLS)
    header = F.regexp_extract("html", r"(?s)<header\b[^>]*>(.*?)</header>", 1)
    df = df.withColumn("header", F.filter(H.text_nodes(header), lambda node: node != ""))
    df = df.where(records.valid_header(F.col("header")))
    heading = F.transform("header", X.unescape)
    body = H.element_bodies(F.col("html"), r'<div[^>]*\bclass="content"[^>]*>')
    df = df.withColumn("body", F.array_join(body, "<div>"))
    df = df.withColumns(
        {
            "heading": K.clean_tokens(heading, K.BLANKS_TWICE, keep_blank=True),
            "body": K.tokens_of(F.col("body"), K.BLANKS_TWICE, keep_blank=True),
            "date_text": _english(H.first_group(F.col("html"), r'<div[^>]*\bclass="date"[^>]*>([^<]*)')),
        }
    )
    extra = H.rest(F.col("heading"), 4)
    df = df.withColumns(
        {
            "name": F.get("heading", F.lit(1)),
            "organiser": F.get("heading", F.lit(2)),
            "content": F.concat(extra, F.col("body")),
        }
    )
    df = _dated(df, R.THE_MILLS, as_of)
    content = F.col("content")
    about = K.join_tokens(content, "\n", closed=True)
    kind = classify.classify(F.col("name"), R.TYPE_RULES[R.THE_MILLS])
    return _two_languages(
        df,
        R.THE_MILLS,
        {
            "description_eng": _english(about),
            "description_chi": _chinese(about),
            "organiser_eng": _english(F.col("organiser")),
            "organiser_chi": _chinese(F.col("organiser")),
            "location_eng": _english(K.venue_sentence(content, "venue", "Venue")),
            "location_chi": _chinese(K.venue_sentence(content, "地點")),
            "fee": _english(K.first_price_token(content)),
            "event_type_eng": _english(kind),
            **_dates(),
        },
        F.col("name").isNotNull() & F.col("organiser").isNotNull() & _date_ok(),
    )


def film_archive(pages: DataFrame, as_of: AsOf) -> DataFrame:
    df = _pages(pages, R.FILM_ARCHIVE)
    options = {"nbsp": "", "delete": ("#",)}
    article = F.regexp_extract("html", r'(?s)(?:id="article"|<article\b)[^>]*>(.*)', 1)
    table = F.regexp_extract("html", r'(?s)<table[^>]*\bclass="table_main"[^>]*>(.*?)</table>', 1)
    df = df.withColumns({"article": article, "table": table})
    df = df.withColumns(
        {
            "paragraphs": H.paragraphs(F.regexp_replace("article", r"(?s)<table\b.*?</table>", "")),
            "cells": F.transform(
                H.all_groups(F.col("table"), r"(?s)<tr\b[^>]*>(.*?)</tr>"),
                lambda row: F.transform(H.all_groups(row, r"(?s)<td\b[^>]*>(.*?)</td>"), X.strip_tags),
            ),
        }
    )
    second = F.get("paragraphs", F.lit(1))
    strong = F.flatten(
        F.transform(H.all_groups(second, r"(?s)<strong\b[^>]*>(.*?)</strong>"), H.text_nodes)
    )
    df = df.withColumns(
        {
            "in_table": F.col("table") != "",
            "strong": F.transform(F.filter(strong, lambda t: t != ""), X.unescape),
            "direct": F.transform(
                H.text_nodes(F.regexp_replace(second, r"(?s)<strong\b.*?</strong>", "")), X.unescape
            ),
        }
    )
    # paragraphs straight in the article, four divisions deep, and (Chinese) five divisions deep
    own = F.col("html").rlike(H.tolerant(r'\bid="article"')[0])
    nested = H.tolerant(r'\bid="article"[^>]*>(?:\s*<div[^>]*>){%d}\s*<p\b')[0]
    df = df.withColumn("deep", F.col("html").rlike(nested % 4))
    # beside a table, what is strong counts in the nested layout only
    in_strong = (F.size("strong") > 0) & (~F.col("in_table") | F.col("deep"))
    # every field: the first layout that yields something, whatever the others of the page yielded
    first_strong = F.when(in_strong, F.slice("strong", F.lit(1), F.lit(1)))
    first_cells = F.array_compact(F.transform(H.rest(F.col("cells")), lambda row: F.get(row, F.lit(0))))
    partner_date = F.array_compact(F.array(H.first_group(F.col("article"), H.PARAGRAPH)))
    texts = F.transform(
        F.coalesce(first_strong, F.when(F.size(first_cells) > 0, first_cells), partner_date),
        lambda t: X.drop_label(F.coalesce(X.clean_text(t, **options), F.lit("")), "Date："),
    )
    places = (
        F.when(in_strong, F.get("strong", F.lit(1))),
        F.get(F.get("cells", F.lit(1)), F.lit(2)),
        H.first_group(F.col("html"), r'(?s)class="teaserBox"[^>]*>.*?<h2[^>]*>([^<]*)'),
    )
    place = F.coalesce(*[X.none_if(X.drop_label(X.once(value, X.unescape), "Venue：", "地點：")) for value in places])
    df = df.withColumn("deepest", (F.col("lang") == "zh") & F.col("html").rlike(nested % 5))
    deepest = F.col("deepest")
    teaser = F.regexp_extract("html", r"(?s)class='?\"?span12 doppelTeaser'?\"?[^>]*>(.*?)</div>", 1)
    told = (
        F.when(deepest, F.col("paragraphs")),
        F.when(in_strong & ~deepest, H.rest(F.col("paragraphs"), 3)),
        F.when((F.col("in_table") | own) & ~in_strong & ~deepest, H.rest(F.col("paragraphs"))),
        F.array(teaser),
    )
    about = F.coalesce(*[X.none_if(F.trim(X.clean_all(some, "", **options))) for some in told])
    aside = F.array_join(H.all_groups(F.col("html"), r"(?s)<aside\b[^>]*>(.*?)</aside>"), "")
    price = K.first_word_token(F.col("direct"))
    price = F.when(price.contains("免費"), F.lit("Free Admission")).otherwise(price)
    partner = F.col("url").contains(R.PARTNER_HOST)
    df = df.withColumns(
        {
            "name": X.clean_text(F.col("name"), **options),
            "texts": _english(texts),
            "place": place,
            "about": about,
            "fee": _chinese(F.coalesce(
                F.when(in_strong | F.col("deep"), price), F.when(partner, X.dollar_amount_text(X.strip_tags(aside))))),
        }
    )
    # a range or a dotted date is one date; anything else is a list of screenings
    head = F.get("texts", F.lit(0))
    one_date = head.contains(" - ") | head.contains(".")
    df = df.withColumn("date_text", F.when(one_date, head))
    df = D.with_date_range(df, "date_text", as_of, "open")
    df = df.withColumn("dates", F.when(~one_date, D.screening_dates(F.col("texts"), as_of)))
    df = df.withColumn("start_date", F.coalesce(F.array_min("dates"), "start_date"))
    dated = F.col("start_date").isNotNull() | F.col("end_date").isNotNull()
    return _two_languages(
        df,
        R.FILM_ARCHIVE,
        {
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            "location_eng": _english(F.col("place")),
            "location_chi": _chinese(F.col("place")),
            "fee": F.col("fee"),
            "dates": F.when(F.size("dates") > 0, F.col("dates")),
            **_dates(),
        },
        (F.col("lang") == "zh") | dated,
    )


def asia_society(pages: DataFrame, as_of: AsOf) -> DataFrame:
    """List entries carry the dates, detail pages the rest; the address joins them."""
    single = F.regexp_replace(F.col("url"), "(?<!:)/{2,}", "/")
    listed = _pages(pages, R.ASIA_SOCIETY, "list")
    rule = next(rule for rule in R.LINK_RULES if rule.source == R.ASIA_SOCIETY)
    boxes = H.all_groups(F.col("html"), r'(?s)<div[^>]*\bclass="datetime"[^>]*>(.*?)</div>')
    times = K.tokens_of(F.col("boxes"), K.BLANKS_TWICE, keep_blank=True)
    listed = fields.zip_lists(
        listed.withColumn("boxes", F.array_join(boxes, "<div>")),
        ("source", "lang", "page_id", "fetched_at"),
        link=H.all_groups(F.col("html"), rule.anchor),
        date_text=D.date_tokens(times),
    )
    listed = listed.where(F.col("link").isNotNull())
    listed = links.absolutise(listed, rule.base).withColumnRenamed("link", "url")
    listed = _dated(listed, R.ASIA_SOCIETY, as_of)
    first = _halves(
        listed,
        F.lit(0),
        single,
        {
            **_dates(),
            "fetch_date": F.col("fetched_at"),
            "link_eng": F.col("url"),
            "extract_ok": F.col("start_date").isNotNull(),
        },
        pos="pos",
    )
    detail = _pages(pages, R.ASIA_SOCIETY)

    def meta(attribute: str, name: str) -> Column:
        return F.replace(X.once(H.meta_content(F.col("html"), attribute, name), X.unescape), F.lit(X.NBSP), F.lit(""))

    paragraphs = F.transform(
        H.all_groups(F.col("html"), rf"(?s)(<[pP]\b[^>]*>.*?){H.PARAGRAPH_END}"),
        lambda p: F.concat(p, F.lit("</p>")),
    )
    detail = detail.withColumns(
        {
            "title": meta("property", "og:title"),
            "about": meta("name", "description"),
            "fee": X.fee_around_dollar(K.clean_tokens(paragraphs, K.BLANKS_TWICE, keep_blank=True)),
        }
    )
    second = _halves(
        detail,
        F.lit(1),
        single,
        {
            "event_name_eng": F.col("title"),
            "description_eng": F.col("about"),
            "fee": X.unescape(F.col("fee")),
            "organiser_eng": X.organiser_of_title(F.col("title")),
            "event_type_eng": classify.classify(F.col("title"), R.TYPE_RULES[R.ASIA_SOCIETY]),
            "extract_ok": F.col("title").isNotNull() & F.col("about").isNotNull(),
        },
    )
    return first.unionByName(second)


def asia_world_expo(pages: DataFrame, as_of: AsOf) -> DataFrame:
    """Entries of the list pages in both languages, keyed by the id of the entry."""
    options = {"nbsp": ""}
    listed = _pages(pages, R.ASIA_WORLD_EXPO, "list")
    entries = fields.zip_lists(
        listed,
        ("source", "lang", "page_id", "fetched_at", "url"),
        head=H.all_groups(F.col("html"), r"(?s)(<dt\b.*?</dt>)"),
        body=H.all_groups(F.col("html"), r"(?s)<dd\b[^>]*>(.*?)</dd>"),
    )
    rules = [rule for rule in R.FIELD_RULES if rule.source == R.ASIA_WORLD_EXPO]
    entries = fields.extract_fields(entries, rules, html="head")
    info = F.regexp_extract("body", r'(?s)<div[^>]*\bclass="info clearfix"[^>]*>(.*)', 1)
    box = F.regexp_extract(
        "head", r'(?s)<div[^>]*\bclass="date big-date is-(?:single|range)-date "[^>]*>(.*?)</div>', 1
    )
    entries = entries.withColumns(
        {
            "event_id": H.first_group(F.col("head"), r'\bid="([^"]+\d{4})"'),
            "place": X.once(
                H.first_group(F.col("head"), r'(?s)class="title-wrapper"[^>]*>.*?<span[^>]*>([^<\n]+)</span>'), X.unescape
            ),
            "info": info,
            "date_text": X.squeeze(X.once(F.regexp_replace(box, "<[^>]*>", " "), X.unescape)),
        }
    )
    paragraphs = H.paragraphs(F.col("info"))
    hosts = F.regexp_extract("info", r'(?s)<p[^>]*\bclass="organiser-list"[^>]*>(.*?)</p>', 1)
    entries = entries.withColumns(
        {
            "about": X.clean_all(H.rest(paragraphs), "", **options),
            "organiser": X.clean_all(H.all_groups(hosts, r"<a\b[^>]*>([^<]*)</a>"), "", **options),
            "name": X.unescape(F.col("name")),
        }
    )
    entries = _dated(entries, R.ASIA_WORLD_EXPO, as_of)
    halves = _halves(
        entries,
        F.when(F.col("lang") == "en", 0).otherwise(1),
        F.col("event_id"),
        {
            "event_name_eng": _english(F.col("name")),
            "event_name_chi": _chinese(F.col("name")),
            "description_eng": _english(F.col("about")),
            "description_chi": _chinese(F.col("about")),
            "location_eng": _english(F.col("place")),
            "location_chi": _chinese(F.col("place")),
            "organiser_eng": _english(F.col("organiser")),
            "organiser_chi": _chinese(F.col("organiser")),
            "link_eng": _english(F.col("url")),
            "link_chi": _chinese(F.col("url")),
            "fetch_date": F.col("fetched_at"),
            "extract_ok": F.col("aligned") & F.col("name").isNotNull() & F.col("start_date").isNotNull(),
            **_dates(),
        },
        pos="pos",
    )
    # a page with an id has a key: the entry's own, costly one is only looked at without
    return halves.where(F.col("page_id").isNotNull() | F.col("link_key").isNotNull())


EXTRACT: dict[str, Callable[[DataFrame, AsOf], DataFrame]] = {
    R.ASIA_SOCIETY: asia_society,
    R.ASIA_WORLD_EXPO: asia_world_expo,
    R.FILM_ARCHIVE: film_archive,
    R.MUSEUM_OF_ART: museum_of_art,
    R.TOURISM_BOARD: tourism_board,
    R.TRADE_COUNCIL: trade_council,
    R.PMQ: pmq,
    R.TAIKOO: taikoo,
    R.TAI_KWUN: tai_kwun,
    R.THE_MILLS: the_mills,
    R.WEST_KOWLOON: west_kowloon,
}


def page_halves(pages: DataFrame, as_of: AsOf, sources: list[str] | None = None) -> DataFrame:
    """Half records of the pages of all venues or some; no shuffle."""
    return records.union_sources(
        [plan(pages, as_of) for name, plan in EXTRACT.items() if not sources or name in sources]
    )


def ticket_fees(pages: DataFrame) -> DataFrame:
    """Fees of the film archive's ticket pages: (url, fee, fetched_at, page_id)."""
    fee_pages = _pages(pages, R.FILM_ARCHIVE, "fee")
    fee = bilingual.fee_of_ticket_page(F.col("html"))
    secure = F.regexp_replace("url", "^https?://", "https://")
    return fee_pages.select(secure.alias("url"), fee.alias("fee"), "fetched_at", "page_id")


def _with_ticket_fees(events: DataFrame, fees: DataFrame) -> DataFrame:
    """A fee missing on the Chinese page is on the ticket page beside it."""
    own = F.when(~F.col("link_chi").contains(R.PARTNER_HOST), F.col("link_chi"))
    events = events.withColumn("_beside", own)
    return bilingual.lookup_fees(events, fees, "_beside").drop("_beside")


def _with_shared_fields(events: DataFrame) -> DataFrame:
    """Locations serve both languages, and the class name is translated."""
    name = classify.translate_type(F.col("event_type_eng"), R.TYPE_RULES[R.THE_MILLS])
    events = events.withColumn("event_type_chi", F.when(F.col("has_twin"), name))
    return bilingual.fill_location(events, F.col("has_twin"))


def assemble(
    halves_of: Callable[[list[str]], DataFrame],
    fees: Callable[[], DataFrame],
    sources: list[str] | None = None,
    defaults: dict[str, dict[str, str]] = R.DEFAULTS,
) -> DataFrame:
    """Event records of half records. ``halves_of`` gives the halves of some venues.

    The venues whose paired records need more are paired on their own, so that the records of the
    others do not pass through the join with the ticket pages.
    """
    chosen = [name for name in EXTRACT if not sources or name in sources]
    special = (R.ASIA_WORLD_EXPO, R.FILM_ARCHIVE, R.THE_MILLS)
    plain = [name for name in chosen if name not in special]
    parts = [bilingual.pair_languages(halves_of(plain))] if plain else []
    if R.THE_MILLS in chosen:
        parts.append(_with_shared_fields(bilingual.pair_languages(halves_of([R.THE_MILLS]))))
    if R.FILM_ARCHIVE in chosen:
        parts.append(_with_ticket_fees(bilingual.pair_languages(halves_of([R.FILM_ARCHIVE])), fees()))
    if R.ASIA_WORLD_EXPO in chosen:
        parts.append(bilingual.merge_languages(halves_of([R.ASIA_WORLD_EXPO])))
    return records.conform(records.union_sources(parts), defaults)


def extract_events(
    pages: DataFrame,
    as_of: AsOf,
    sources: list[str] | None = None,
    defaults: dict[str, dict[str, str]] = R.DEFAULTS,
) -> DataFrame:
    """Pages to event records, for all venues or some.

    A missing value stays NULL, unless ``defaults`` says otherwise:
    ``rules.published_defaults()`` puts in the text markers.
    """
    return assemble(
        lambda names: page_halves(pages, as_of, names), lambda: ticket_fees(pages), sources, defaults
    )


def detail_links(pages: DataFrame) -> DataFrame:
    """Addresses of the event pages on the list pages, each once per source."""
    parts = []
    for rule in R.LINK_RULES:
        mine = _pages(pages, rule.source, "list")
        region = H.element_of(F.col("html"), rule.within) if rule.within else F.regexp_extract("html", H.tolerant(rule.region)[0], 1)
        targets = H.all_groups(region, rule.anchor)
        found = mine.select("source", "page_id", F.posexplode(targets).alias("pos", "link"))
        if rule.every_second:
            found = links.every_second(found)
        if rule.contains:
            found = found.where(F.col("link").contains(rule.contains))
        parts.append(links.absolutise(found, rule.base) if rule.base else found)
    cards = links.card_links(
        _pages(pages, R.THE_MILLS, "list"), R.MILLS_CARD, R.MILLS_DATED, R.MILLS_PREFIX, ("source",)
    )
    cards = links.first_of_card(links.without_denied(cards, R.DENIED), ("source", "page_id", "card"))
    parts.append(cards.select("source", "page_id", F.col("card").alias("pos"), "link"))
    return links.first_links(records.union_sources(parts), ("source", "link"), ("page_id", "pos"))


def seed_addresses(spark: SparkSession) -> DataFrame:
    """All list pages the venues start from."""
    kinds = "source string, url string, low int, high int, suffix string, first date, last date"
    rows = [
        (s.source, s.url, s.low, s.high, s.suffix, *[
            datetime.date.fromisoformat(m) if m else None for m in (s.first_month, s.last_month)
        ])
        for s in R.SEEDS
    ]
    seeds = spark.createDataFrame(rows, kinds)
    plain = seeds.where("low is null and first is null").select("source", "url")
    numbered = P.seed_pages(seeds.where("low is not null"), "low", "high").select("source", "url")
    monthly = P.seed_months(seeds.where("first is not null"), "first", "last").select("source", "url")
    return plain.unionByName(numbered).unionByName(monthly)
