"""Pages in the form of each venue, written from rows of a table.

For round trips: a page is rendered from columns, extracted, and compared with the columns. All
texts are invented. One row gives one English and one Chinese page (or their list pages).
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import PAGES
from . import rules as R

AS_OF = datetime.date(2020, 6, 18)
FETCHED = "2020-06-18 06:00:00"


def template(text: str, **columns: Column) -> Column:
    """A text with {names} replaced by columns."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", text):
        if piece[:1] == "{" and piece[1:-1] in columns:
            pieces.append(columns[piece[1:-1]].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def show_rows(orders: DataFrame) -> DataFrame:
    """The columns the pages are rendered from."""
    start = F.col("o_orderdate").cast("date")
    form = F.substring("o_orderpriority", 1, 1).cast("int")
    return orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        start.alias("d"),
        F.date_add(start, form * 7).alias("e"),
        form.alias("n"),
        F.col("o_orderstatus").alias("s"),
        F.floor("o_totalprice").alias("price"),
    )


def _fmt(column: str, pattern: str) -> Column:
    return F.date_format(column, pattern)


def page_rows(df: DataFrame, source: str, *pages: tuple[str, str, Column, Column, Column | None]) -> DataFrame:
    """Rows of pages: (kind, lang, url, html, condition) each."""
    entries = []
    for number, (kind, lang, url, html, test) in enumerate(pages):
        page = F.struct(
            (F.col("k") * 10 + number).cast("long").alias("page_id"),
            F.lit(source).alias("source"),
            F.lit(kind).alias("page_kind"),
            F.lit(lang).alias("lang"),
            url.alias("url"),
            html.alias("html"),
        )
        entries.append(page if test is None else F.when(test, page))
    stacked = df.select(F.explode(F.array_compact(F.array(*entries))).alias("page"))
    stacked = stacked.select("page.*", F.lit(FETCHED).cast("timestamp").alias("fetched_at"))
    return stacked.select(*PAGES.names)


def _both(df: DataFrame, source: str, address: str, english: str, chinese: str, en: Column, zh: Column,
          **columns: Column) -> DataFrame:
    """An English page, and a Chinese one unless the order is pending."""
    columns = {"k": F.col("k"), **columns}
    return page_rows(
        df,
        source,
        ("detail", "en", template(address, lang=F.lit(english), **columns), en, None),
        ("detail", "zh", template(address, lang=F.lit(chinese), **columns), zh, F.col("s") != "P"),
    )


_HEAD = (
    '<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title>'
    '<style>p{margin:0}</style><script>var t="<p>Date</p>";</script></head><body>'
)
_TAIL = "<footer>&copy; all &middot; rights</footer></body></html>"


def _page(body: str, title: Column | None = None, **columns: Column) -> Column:
    named = {name: F.col(name) for name in ("k", "c", "price")}
    return template(_HEAD + body + _TAIL, **{**named, **columns, "title": title if title is not None else F.lit("page")})


def west_kowloon(df: DataFrame) -> DataFrame:
    single = F.col("n") == 1
    dates = F.when(single, _fmt("d", "dd.MM.yyyy")).otherwise(
        F.concat(_fmt("d", "dd.MM.yyyy"), F.lit(" to "), _fmt("e", "dd.MM.yyyy"))
    )
    fee = F.when(F.col("s") == "F", F.lit("<p><strong>Free</strong> for all</p>")).otherwise(
        template("<p><strong>Tickets: </strong> ${price} &amp; up</p>", price=F.col("price"))
    )
    body = (
        '<div id="main"><div><header><div><h1>{show}{k}</h1></div></header></div><section>'
        "<article><div><div><p>{about} <b>{k}</b> &amp; more</p>{fee}</div></div></article>"
        "<aside><div><dl><dt>{date}</dt><dd>\n\t{dates}\n</dd><dt>{venue}</dt><dd><b>{c}</b>{hall}</dd></dl>"
        "</div></aside></section></div>"
    )
    english = dict(show=F.lit("Show "), about=F.lit("About"), date=F.lit("Date"), venue=F.lit("Venue"),
                   hall=F.lit(" Hall"), dates=dates, fee=fee)
    chinese = dict(show=F.lit("節目"), about=F.lit("關於"), date=F.lit("日期"), venue=F.lit("地點"),
                   hall=F.lit("號廳"), dates=dates, fee=F.lit(""))
    return _both(df, R.WEST_KOWLOON, "https://west.example/{lang}/show/{k}", "en", "tc",
                 _page(body, **english), _page(body, **chinese))


def tai_kwun(df: DataFrame) -> DataFrame:
    month, year = _fmt("d", "yyyyMM") == _fmt("e", "yyyyMM"), _fmt("d", "yyyy") == _fmt("e", "yyyy")
    last = _fmt("e", "d MMM, yyyy")
    dates = (
        F.when(F.col("n") == 1, _fmt("d", "d MMM, yyyy"))
        .when(month, F.concat(_fmt("d", "d"), F.lit(" - "), last))
        .when(year, F.concat(_fmt("d", "d MMM"), F.lit(" - "), last))
        .otherwise(F.concat(_fmt("d", "d MMM, yyyy"), F.lit(" - "), last))
    )
    body = (
        "{name}<div><div><div><div><div><div>Date</div><div><div><label>{dates}</label></div></div></div></div>"
        "<div><div><div>Place</div><div><div>{hall}</div><div>map</div></div></div></div>"
        "<div><div><div>Price</div><div><div>${price}&nbsp;each</div></div></div></div></div></div></div>"
        "<div><section><div><div><div><div>{inner}</div></div></div></div>"
        "<article><div>About</div><div><p>{about}\n{k}</p><p>R&amp;D</p></div></article></section></div></div>"
    )

    def page(show: str, about: str, hall: Column) -> Column:
        labelled = {"show": F.lit(show), "k": F.col("k")}
        heading = F.when(
            F.col("n") == 2,
            template('<div class="page-title-section container "><div><span>{show}{k}</span></div></div>'
                     '<div id="programme-content">', **labelled),
        ).otherwise(F.lit('<div id="programme-content">'))
        inside = F.when(F.col("n") == 2, F.lit("")).otherwise(template("<span>{show}{k}</span>", **labelled))
        return _page(body, name=heading, inner=inside, about=F.lit(about), hall=hall, dates=dates)

    return _both(df, R.TAI_KWUN, "https://kwun.example/{lang}/programme/{k}", "en", "zh",
                 page("Show ", "About ", F.concat(F.lit("Hall "), "c")),
                 page("節目", "關於", F.concat("c", F.lit("號廳"))))


def tourism_board(df: DataFrame) -> DataFrame:
    month, year = _fmt("d", "yyyyMM") == _fmt("e", "yyyyMM"), _fmt("d", "yyyy") == _fmt("e", "yyyy")
    last = _fmt("e", "d MMMM yyyy")
    dates = (
        F.when(F.col("n") == 1, _fmt("d", "d MMMM yyyy"))
        .when(month, F.concat(_fmt("d", "d"), F.lit("–"), last))
        .when(year, F.concat(_fmt("d", "d MMMM"), F.lit(" to "), last))
        .otherwise(F.concat(_fmt("d", "d MMM yyyy"), F.lit(" to "), _fmt("e", "d MMM yyyy")))
    )
    fee = F.when(F.col("s") == "F", F.lit("")).otherwise(
        template("<p><b>Admission</b></p><p>${price}</p>", price=F.col("price"))
    )
    body = (
        '<p>date</p><div class="cmp-text"><p>{about}{k}</p><p>\n</p></div><div>venue</div>'
        '<div class="cmp-text"><div><p><b>{date}</b></p><p> {dates}</p></div><p>{venue}</p><p>{hall}</p>{fee}'
        "<p>{type}</p><p>Music</p><p>{org}</p><p>{club} &amp; co</p></div>"
    )
    english = _page(body, title=F.concat(F.lit("Show "), "k"), about=F.lit("About "), date=F.lit("Date"),
                    dates=dates, venue=F.lit("VENUE"), hall=F.concat(F.lit("Hall "), "c"), fee=fee,
                    type=F.lit("Category(-ies)"), org=F.lit("Organiser"), club=F.concat(F.lit("Club "), "c"))
    chinese = _page(body, title=F.concat(F.lit("節目"), "k"), about=F.lit("關於"), date=F.lit("日期"),
                    dates=dates, venue=F.lit("地點"), hall=F.concat("c", F.lit("號廳")), fee=F.lit(""),
                    type=F.lit("類別"), org=F.lit("主辦機構"), club=F.concat(F.lit("會"), "c"))
    return _both(df, R.TOURISM_BOARD, "https://tour.example/{lang}/events/{k}.html", "us", "tc", english, chinese)


def trade_council(df: DataFrame) -> DataFrame:
    body = (
        '<font color="black">{show}{k}</font><table><tr><td class="background_white_padding_middle">'
        "<table><tr><td>{date}</td><td>\n\t{dates}</td></tr></table><b>{what}</b> {about}{k}<br>"
        "<b>{form}</b>{webinar}<br><b>{org}</b>{club}<br>{fee}</td><td>venue</td></tr></table>"
    )
    dates = _fmt("d", "d MMM yyyy (EEE)")
    fee = F.when(F.col("s") == "F", F.lit("")).otherwise(
        template("<b>Participation Fee:</b>HK${price}", price=F.col("price"))
    )
    english = _page(body, show=F.lit("Show "), date=F.lit("Date:"), dates=dates, what=F.lit("Description:"),
                    about=F.lit("About "), form=F.lit("Format:"), webinar=F.lit("Webinar"),
                    org=F.lit("Organiser:"), club=F.concat(F.lit("Club "), "c"), fee=fee)
    chinese = _page(body, show=F.lit("節目"), date=F.lit("日期:"), dates=dates, what=F.lit("詳細資料:"),
                    about=F.lit("關於"), form=F.lit("形式:"), webinar=F.lit("網上"),
                    org=F.lit("主辦機構:"), club=F.concat(F.lit("會"), "c"), fee=F.lit(""))
    columns = {"k": F.col("k")}
    address = "http://trade.example/{lang}/fair/{k}"
    return page_rows(
        df,
        R.TRADE_COUNCIL,
        ("detail", "zh", template(address, lang=F.lit("tc"), **columns), chinese, None),
        ("detail", "en", template(address, lang=F.lit("en"), **columns), english, F.col("s") != "P"),
    )


def pmq(df: DataFrame) -> DataFrame:
    dash = F.lit(" – ")
    weekday = "d MMM yyyy (EEE)"
    dates = (
        F.when(F.col("n") == 1, _fmt("d", "MMMM yyyy"))
        .when(F.col("n") == 2, F.concat(_fmt("d", "MMMM yyyy"), dash, _fmt("e", "MMM yyyy")))
        .when(F.col("n") == 3, F.concat(_fmt("d", weekday), dash, _fmt("e", weekday)))
        .when(F.col("n") == 4, F.concat(F.lit("Now"), dash, _fmt("e", "MMMM yyyy")))
        .otherwise(F.concat(_fmt("d", weekday), dash, F.lit("onward")))
    )
    body = (
        '<div class="container"><div><a>{back}</a>{type}<h2>{show}{k}</h2></div>'
        "<div><b>{date}</b><div>{dates}</div></div><div><b>{venue}</b><div> {hall}</div></div>"
        "<div><b>{price_label}</b><div>${price}</div></div>"
        '<div class="field2 pull-left gapPadding20 size18"><p>{about}{k}</p><p>{second}</p>'
        "<p>{sentinel}</p><p>address</p></div><div><b>{org}</b><div>{club}</div></div></div><div>venue</div>"
    )
    def page(kind: str, **labels: Column) -> Column:
        shown = F.when(F.col("s") == "F", F.lit("")).otherwise(F.lit(f"<span>{kind}</span>"))
        return _page(body, type=shown, dates=dates, **labels)

    english = page("Talk", back=F.lit("Back to monthly calendar"), show=F.lit("Show "), date=F.lit("DATE"),
                   venue=F.lit("VENUE"), hall=F.concat(F.lit("Hall "), "c"), price_label=F.lit("FEE (HKD)"),
                   about=F.lit("About "), second=F.lit("See you"), sentinel=F.lit("Know more about "),
                   org=F.lit("PRESENTED &amp; ORGANIZED"), club=F.concat(F.lit("Club "), "c"))
    chinese = page("講座", back=F.lit("返回查看活動一覧"), show=F.lit("節目"), date=F.lit("日期"),
                   venue=F.lit("場地"), hall=F.concat("c", F.lit("號廳")), price_label=F.lit("費用"),
                   about=F.lit("關於"), second=F.lit("再見"), sentinel=F.lit("有關 "),
                   org=F.lit("主辦"), club=F.concat(F.lit("會"), "c"))
    columns = {"k": F.col("k")}
    address = "https://pmq.example/programme/{k}/?lang={lang}"
    return page_rows(
        df,
        R.PMQ,
        ("detail", "zh", template(address, lang=F.lit("ch"), **columns), chinese, None),
        ("detail", "en", template(address, lang=F.lit("en"), **columns), english, F.col("s") != "P"),
    )


def museum_of_art(df: DataFrame) -> DataFrame:
    iso = "yyyy-MM-dd"
    dates = (
        F.when(F.col("n") == 1, F.concat(F.lit("From "), _fmt("d", iso)))
        .when(F.col("n") == 2, F.concat(F.lit("Until "), _fmt("e", iso)))
        .otherwise(F.concat(_fmt("d", iso), F.lit(" – "), _fmt("e", iso)))
    )
    body = (
        '<div id="single-exhibition-hero-banner"><div><h1>{show}{k}</h1></div></div>'
        '<div id="single-exhibition-content"><div><div><div></div><div><div><p>{about}<i>{k}</i></p><p>more</p>'
        "</div></div><div><ul><div>{date}</div><div>{dates}</div><li><div>{venue}:</div><div> {hall} </div></li>"
        "<div>{fee}</div><div>${price}</div></ul></div></div></div></div>"
    )
    english = _page(body, show=F.lit("Show "), about=F.lit("About "), date=F.lit("Event Date"), dates=dates,
                    venue=F.lit("Venue"), hall=F.concat(F.lit("Hall "), "c"), fee=F.lit("Fee"))
    chinese = _page(body, show=F.lit("節目"), about=F.lit("關於"), date=F.lit("日期"), dates=dates,
                    venue=F.lit("地點"), hall=F.concat("c", F.lit("號廳")), fee=F.lit("費用"))
    return _both(df, R.MUSEUM_OF_ART, "http://museum.example/{lang}/web/ma/{k}.html", "en_US", "zh_TW",
                 english, chinese)


def taikoo(df: DataFrame) -> DataFrame:
    """The key is spelled in letters: four digits of an address would count as a year."""
    key = F.translate(F.col("k").cast("string"), "0123456789", "abcdefghij")
    mark = F.when(F.col("s") == "F", F.lit(" In 2019.")).otherwise(F.lit(""))
    told = (
        F.when(F.col("n") == 1, F.concat(F.lit("Open on "), _fmt("d", "d MMMM yyyy")))
        .when(F.col("n") == 2, F.concat(F.lit("Open "), _fmt("d", "d"), F.lit(" - "),
                                        F.date_format(F.last_day("d"), "d MMM, yyyy")))
        .when(F.col("n") == 3, F.concat(F.lit("From "), _fmt("d", "d"), F.lit("th "), _fmt("d", "MMMM")))
        .when(F.col("n") == 4, F.concat(_fmt("d", "MMMM yyyy"), F.lit(" and "), _fmt("e", "d MMM yyyy")))
        .otherwise(F.lit("Maybe at the Market"))
    )
    boxes = (
        F.when(F.col("s") == "F", F.lit("<div>Free entry</div>"))
        .when(F.col("s") == "P", F.concat(F.lit("<div>"), "hall", F.lit("</div>")))
        .otherwise(F.concat(F.lit("<div>"), "hall", F.lit("</div><div>$"), "price", F.lit("</div>")))
    )
    body = (
        '<form id="mainform"><div><h1><span>{show}{k}</span></h1><div><div>{boxes}</div></div>'
        '<div class="event-detail__copy body-copy"> <p>{told}.\n</p><div>{mark}</div> <p> Bye &amp; see</p></div></div></form>'
    )

    def page(show: str, hall: Column) -> Column:
        filled = F.col("boxes_en") if show == "Show " else F.col("boxes_zh")
        return _page(body, show=F.lit(show), told=told, mark=mark, boxes=filled)

    df = df.withColumn("hall", F.concat(F.lit("Hall "), "c")).withColumn("boxes_en", boxes)
    df = df.withColumn("hall", F.concat("c", F.lit("號廳"))).withColumn("boxes_zh", boxes)
    return _both(df, R.TAIKOO, "http://taikoo.example/{lang}/whatson/{k}", "en", "zh-hk",
                 page("Show ", F.col("hall")), page("節目", F.col("hall")), k=key)


def the_mills(df: DataFrame) -> DataFrame:
    month, year = _fmt("d", "yyyyMM") == _fmt("e", "yyyyMM"), _fmt("d", "yyyy") == _fmt("e", "yyyy")
    dot = "yyyy.MM.dd"
    dates = (
        F.when(F.col("n") == 1, _fmt("d", dot))
        .when(month, F.concat(_fmt("d", dot), F.lit(" - "), _fmt("e", "dd")))
        .when(year, F.concat(_fmt("d", dot), F.lit(" - "), _fmt("e", "MM.dd")))
        .otherwise(F.concat(_fmt("d", dot), F.lit(" - "), _fmt("e", dot)))
    )
    kind = (
        F.when(F.col("n") == 1, F.lit("Concert and Workshop "))
        .when(F.col("n") == 2, F.lit("Big Exhibition "))
        .when(F.col("n") == 3, F.lit("Market day "))
        .otherwise(F.lit("DIY Sale "))
    )
    heading = F.when(F.col("n") == 5, F.lit("<b>Mills</b>")).otherwise(
        F.concat(F.lit("<b>Mills</b><h1>"), kind, "k", F.lit("</h1><h2>Club "), "c", F.lit("</h2>"),
                 F.when(F.col("s") == "F", F.lit("<i>Extra line</i>")).otherwise(F.lit("")))
    )
    heading_zh = F.when(F.col("n") >= 4, F.lit("<b>Mills</b>")).otherwise(
        F.concat(F.lit("<b>Mills</b><h1>節目"), "k", F.lit("</h1><h2>會"), "c", F.lit("</h2>"))
    )
    price = F.when(F.col("s") == "F", F.lit("<p>Only $5.50</p><p>$10</p>")).otherwise(
        F.concat(F.lit("<p>Fee $"), "price", F.lit("</p>"))
    )
    place = F.when(F.col("n") == 2, F.lit("")).otherwise(F.concat(F.lit("<p>Come. Venue: Hall "), "c", F.lit("! Soon</p>")))
    place_zh = F.when(F.col("n") == 1, F.lit("")).otherwise(F.concat(F.lit("<p>地點：廳"), "c", F.lit("</p>")))
    body = (
        '<header>{heading}</header><div class="date">{dates}</div>'
        '<div class="content"><div><p>{about}</p></div>{place}{price}</div>'
    )
    english = _page(body, heading=heading, dates=dates, about=F.concat(F.lit("About "), "k"), place=place, price=price)
    chinese = _page(body, heading=heading_zh, dates=dates, about=F.concat(F.lit("關於"), "k"), place=place_zh, price=F.lit(""))
    return _both(df, R.THE_MILLS, "http://mills.example/{lang}/event/{k}", "en", "ch", english, chinese)


def film_archive(df: DataFrame) -> DataFrame:
    """Five layouts: two with paragraphs, two with a table, one of the partner's pages. Some pages with
    paragraphs have a table too, and some tables no place, which is in a box then."""
    n, slash = F.col("n"), "d/M/yyyy"
    dates = F.when(
        n == 1, F.concat(_fmt("d", slash + " (EEE)"), F.lit(" - "), _fmt("e", slash + " (EEE)"))
    ).otherwise(_fmt("d", "d.M.yyyy"))
    cell = F.when(n == 3, F.lit(1)).otherwise(F.lit(0))
    first = F.when(cell == 1, _fmt("d", slash + " (EEE)")).otherwise(_fmt("d", "d/M (EEE)"))
    second = F.when(cell == 1, _fmt("e", "EEE, d/M/yyyy")).otherwise(_fmt("e", "d/M"))
    fee = F.when(F.col("s") == "F", F.lit("免費入場")).otherwise(F.concat(F.lit("票價 $"), "price"))
    paragraphs = (
        '<div id="title_bar_left">{show}{k}</div><div id="article"><div><div><div><div><p>Intro</p>'
        "<p><strong>Date：{dates}</strong> — <strong>{venue}{hall}</strong><br>{fee}</p>"
        "<p>{about}{k}#</p><p>More &amp; more</p></div></div></div></div></div>"
    )
    table = (
        '<div id="title_bar_left">{placeholder}</div><div id="article"><p><span><strong>{show}{k}</strong></span></p>'
        '<p>{about}{k}</p><p>More &amp; more</p><table class="table_main"><tbody><tr><th>Date</th></tr>'
        "<tr><td>{first}</td><td>7pm</td><td> {hall} </td></tr><tr><td>{second}</td><td>8pm</td><td>Other</td></tr>"
        "</tbody></table></div>"
    )
    beside = paragraphs + '<table class="table_main"><tbody><tr><th>x</th></tr><tr><td>1/1</td><td>x</td><td>Elsewhere</td></tr></tbody></table>'
    boxed = table.replace("<td> {hall} </td>", "") + '<div class="teaserBox"><h2>{hall}</h2></div>'
    partner = (
        '<article><div class="application"><h1>{show}<b>{k}</b></h1></div><div><div><p>{dates}</p></div></div>'
        '<div class="teaserBox"><h2>{hall}</h2></div><div class="span12 doppelTeaser">{about}{k}More &amp; more</div>'
        "<aside><p>Entry fee: ${price}</p></aside></article>"
    )

    def page(lang: str, **labels: Column) -> Column:
        labels = {**labels, "dates": dates, "first": first, "second": second}
        return (
            F.when((n == 2) & (F.col("s") == "O"), _page(beside, fee=fee, **labels))
            .when((n == 3) & (F.col("s") == "F"), _page(boxed, **labels))
            .when(n <= 2, _page(paragraphs, fee=fee, **labels))
            .when(n <= 4, _page(table, **labels))
            .otherwise(_page(partner, **labels))
        )

    english = page("en", show=F.lit("Show "), about=F.lit("About "), venue=F.lit("Venue："),
                   hall=F.concat(F.lit("Hall "), "c"), placeholder=F.lit("Film Screenings"))
    chinese = page("zh", show=F.lit("節目"), about=F.lit("關於"), venue=F.lit("地點："),
                   hall=F.concat("c", F.lit("號廳")), placeholder=F.lit("電影放映"))
    ticket = _page('<div id="article"><p>Tickets</p><p><span> — <strong>票價：${price}</strong></span></p></div>')

    def address(lang: str, other: str, last: str) -> Column:
        own = template("http://film.example/{lang}/web/{k}/" + last, lang=F.lit(lang), k=F.col("k"))
        away = template("https://goethe.example/{lang}/show/{k}/" + last, lang=F.lit(other), k=F.col("k"))
        return F.when(n == 5, away).otherwise(own)

    ticket_url = template("https://film.example/zh_TW/web/{k}/ticketinfo.html", k=F.col("k"))
    return page_rows(
        df,
        R.FILM_ARCHIVE,
        ("detail", "en", address("en_US", "en", "page.html"), english, None),
        ("detail", "zh", address("zh_TW", "cn", "page.html"), chinese, F.col("s") != "P"),
        ("fee", "zh", ticket_url, ticket, n.isin(3, 4)),
    )


def asia_society(df: DataFrame) -> DataFrame:
    """A list page per row with a card per week, and the detail page of every card."""
    number = F.sequence(F.lit(1), F.col("n"))

    def card(i: Column) -> Column:
        return F.concat(
            F.lit('<div><h4 class="card-title"><a href="hong-kong/events/'), F.col("k").cast("string"), F.lit("-"),
            i.cast("string"), F.lit('">Go</a></h4><div class="datetime">'),
            F.date_format(F.date_add("d", i * 7), "EEE d MMM yyyy"),
            F.when(i % 2 == 0, F.lit("<br> 6:30 - 7:30pm")).otherwise(F.lit("")), F.lit("</div></div>"),
        )

    listing = F.concat(F.lit("<html><body>"), F.array_join(F.transform(number, card), "\n"), F.lit("</body></html>"))
    lists = page_rows(df, R.ASIA_SOCIETY, (
        "list", "en", template("https://asiasociety.org/hong-kong/events?page={k}", k=F.col("k")), listing, None,
    ))
    detail = df.withColumn("i", F.explode(number))
    title = (
        F.when(F.col("i") == 1, F.concat(F.lit("[Online] Club "), "c", F.lit(" @ Chat &amp; Tea")))
        .when(F.col("i") == 2, F.lit("Workshop on jade"))
        .when(F.col("i") == 3, F.lit("Garden party"))
        .when(F.col("i") == 4, F.lit("Performance and DIY"))
        .otherwise(F.lit("The Collection"))
    )
    page = template(
        '<html><head><meta property="og:title" content="{title}"><meta name="description" content="About {k} &amp; more">'
        "</head><body><p>Was $5.50 once</p><p>{price}</p></body></html>",
        title=title, k=F.col("k"),
        price=F.when(F.col("i") == 2, F.concat(F.lit("<b>Cost $"), "price", F.lit(" each</b>"))).otherwise(F.lit("ask")),
    )
    url = template("https://asiasociety.org/hong-kong/events/{k}-{i}", k=F.col("k"), i=F.col("i"))
    return lists.unionByName(page_rows(detail, R.ASIA_SOCIETY, ("detail", "en", url, page, None)))


def asia_world_expo(df: DataFrame) -> DataFrame:
    """List pages per row: filled orders are on the Chinese list only, open ones on the English."""
    number = F.sequence(F.lit(1), F.col("n"))

    def entry(i: Column, lang: str) -> Column:
        single = i == 1
        last = F.last_day("d")
        if lang == "en":
            when = F.when(single, _fmt("d", "d'</span> <span>'MMM'</span> <span>'yyyy")).otherwise(
                F.concat(_fmt("d", "d"), F.lit(" - "), F.date_format(last, "d'</span> <span>'MMM yyyy"))
            )
            name, hall, about, club = "Show ", F.concat(F.lit("Hall "), "c"), "About ", F.concat(F.lit("Club "), "c")
        else:
            pattern = "yyyy年'</span> <span>'M月'</span> <span>'d日"
            when = F.when(single, _fmt("d", pattern)).otherwise(
                F.concat(_fmt("d", pattern), F.lit("</span> - <span>"), F.date_format(last, pattern))
            )
            name, hall, about, club = "節目", F.concat("c", F.lit("號廳")), "關於", F.concat(F.lit("會"), "c")
        kind = F.when(single, F.lit("single")).otherwise(F.lit("range"))
        return F.concat(
            F.lit('<dt id="show-'), F.col("k").cast("string"), F.lit("-"), i.cast("string"), F.lit("-"), _fmt("d", "yyyy"),
            F.lit('"><div class="date big-date is-'), kind, F.lit('-date "><span>'), when,
            F.lit(f'</span></div><h3>{name}'), F.col("k").cast("string"), F.lit("/"), i.cast("string"),
            F.lit('</h3><div class="title-wrapper"><span>\n</span><span>'), hall,
            F.lit('</span></div></dt><dd><div class="info clearfix"><p class="organiser-list">by <a href="#">'), club,
            F.lit("</a><a> &amp; co</a></p><p>"), F.lit(about), F.col("k").cast("string"),
            F.lit("\r\n</p><p> more</p></div></dd>"),
        )

    def listing(lang: str) -> Column:
        entries = F.array_join(F.transform(number, lambda i: entry(i, lang)), "\n")
        return F.concat(F.lit('<div id="content"><dl>'), entries, F.lit("</dl></div>"))

    return page_rows(
        df,
        R.ASIA_WORLD_EXPO,
        ("list", "en", template("http://expo.example/events/{k}", k=F.col("k")), listing("en"), F.col("s") != "F"),
        ("list", "zh", template("https://expo.example/zh-tc/events/{k}", k=F.col("k")), listing("zh"), F.col("s") != "O"),
    )


RENDER = {
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
