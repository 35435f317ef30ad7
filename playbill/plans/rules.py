"""Rules of the eleven venues. Everything here is data: fixed values the results depend on."""

from __future__ import annotations

from typing import NamedTuple

from ..functions.html import HREF, PARAGRAPH_END
from ..operators.classify import TypeRule
from ..operators.fields import FieldRule, LabelRule

ASIA_SOCIETY = "Asia Society"
ASIA_WORLD_EXPO = "Asia World Expo"
FILM_ARCHIVE = "Hong Kong Film Archive"
MUSEUM_OF_ART = "Hong Kong Museum of Arts"
TOURISM_BOARD = "HKTB"
TRADE_COUNCIL = "HKTDC"
PMQ = "PMQ"
TAIKOO = "Tai Koo Place"
TAI_KWUN = "Tai Kwun"
THE_MILLS = "The Mills"
WEST_KOWLOON = "West Kowloon Cultural District"


class Venue(NamedTuple):
    """How the two language versions of a venue's pages are found and read."""

    first_lang: str
    english: str  # the part of an address that differs by language
    chinese: str
    single_end: str  # what the end of a single date is: same or open


VENUES = {
    ASIA_SOCIETY: Venue("en", "", "", "same"),
    ASIA_WORLD_EXPO: Venue("en", "", "", "open"),
    FILM_ARCHIVE: Venue("en", "/en_US/", "/zh_TW/", "open"),
    MUSEUM_OF_ART: Venue("en", "/en_US/", "/zh_TW/", "open"),
    TOURISM_BOARD: Venue("en", "/us/", "/tc/", "same"),
    TRADE_COUNCIL: Venue("zh", "/en/", "/tc/", "same"),
    PMQ: Venue("zh", "?lang=en", "?lang=ch", "same"),
    TAIKOO: Venue("en", "/en/", "/zh-hk/", "open"),
    TAI_KWUN: Venue("en", "/en/", "/zh/", "open"),
    THE_MILLS: Venue("en", "/en/", "/ch/", "same"),
    WEST_KOWLOON: Venue("en", "/en/", "/tc/", "open"),
}

# One host of the film archive's calendar uses other parts.
PARTNER_HOST = "goethe"
PARTNER_VENUE = Venue("en", "/en/", "/cn/", "open")


class Seed(NamedTuple):
    source: str
    url: str
    low: int | None = None
    high: int | None = None
    suffix: str = ""
    first_month: str | None = None
    last_month: str | None = None


SEEDS = (
    Seed(ASIA_SOCIETY, "https://asiasociety.org/hong-kong/events?page=", 0, 1),
    Seed(ASIA_WORLD_EXPO, "http://www.asiaworld-expo.com/events"),
    Seed(ASIA_WORLD_EXPO, "https://www.asiaworld-expo.com/zh-tc/events/"),
    Seed(FILM_ARCHIVE, "http://www.filmarchive.gov.hk/en_US/web/hkfa/programmesandexhibitions/evecal.html"),
    Seed(MUSEUM_OF_ART, "http://hk.art.museum/en_US/web/ma/exhibitions-and-events.html"),
    Seed(TOURISM_BOARD, "https://www.discoverhongkong.com/us/what-s-new/events.html"),
    Seed(TRADE_COUNCIL, "http://www.hktdc.com/info/trade-events/i/CSD/tc/客戶服務.htm?PAGE=", 1, 3),
    Seed(PMQ, "https://www.pmq.org.hk/happenings/programmes-events/?lang=ch&past=1&date=",
         first_month="2020-01-01", last_month="2020-12-01"),
    Seed(TAIKOO, "http://www.taikooplace.com/en/whatson"),
    Seed(TAI_KWUN, "https://www.taikwun.hk/en/programme/"),
    Seed(THE_MILLS, "http://www.themills.com.hk/en/event/page/", 1, 19),
    Seed(WEST_KOWLOON, "https://www.westkowloon.hk/en/whats-on/current-forthcoming/event-type/all/"),
)


class LinkRule(NamedTuple):
    """Where the links to the event pages stand on a list page.

    ``region`` cuts the list out of the page, or ``within`` names the attribute of the element that
    holds it; ``anchor`` finds the targets in it.
    """

    source: str
    region: str
    anchor: str
    base: str = ""
    every_second: bool = False
    contains: str = ""
    within: str = ""


LINK_RULES = (
    LinkRule(ASIA_SOCIETY, r"(?s)(.*)", r'(?s)<h4[^>]*\bclass="card-title"[^>]*>\s*' + HREF,
             base="https://asiasociety.org/"),
    LinkRule(FILM_ARCHIVE, r'(?s)<table[^>]*\bclass="table_main"[^>]*>(.*?)</table>', HREF),
    LinkRule(MUSEUM_OF_ART, r'(?s)class="journal-content-article".*?<ul[^>]*>(.*?)</ul>', HREF,
             base="http://hk.art.museum/en_US/web/ma/"),
    LinkRule(TOURISM_BOARD, "", HREF, within='id="event-calendar"'),
    LinkRule(TRADE_COUNCIL, r"(?s)(.*)",
             r'(?s)class="content_black_middle padding_right_5px"[^>]*>\s*' + HREF,
             contains="www.hktdc.com"),
    LinkRule(PMQ, "", r'(?s)<[^>]*\bclass="col-xs-6"[^>]*>\s*' + HREF, every_second=True,
             within='class="bgWhite container gapPaddingBtm40 gapBtm40"'),
    LinkRule(TAIKOO, "", HREF, base="http://www.taikooplace.com", within='id="mainform"'),
    LinkRule(TAI_KWUN, "", HREF, base="https://www.taikwun.hk/en/", within='id="programme-list"'),
    LinkRule(WEST_KOWLOON, "", r"(?s)<h4[^>]*>\s*" + HREF, within='id="main"'),
)

MILLS_CARD = r'<div class="col-xs-12 col-sm-6 pull-left"[^>]*>'
MILLS_DATED = '<div class="date">'
MILLS_PREFIX = "http://www.themills.com.hk/"
DENIED = (
    "http://www.themills.com.hk/artymoment/",
    "https://www.mill6chat.org/zh-hant/co-learn/current-upcoming",
)


def _both(source: str, field: str, *patterns: str) -> list[FieldRule]:
    return [
        FieldRule(source, lang, field, priority, pattern)
        for lang in ("en", "zh")
        for priority, pattern in enumerate(patterns, 1)
    ]


_DL = r"(?s)<dt[^>]*>\s*{}\s*</dt>\s*<dd[^>]*>(.*?)</dd>"
_FILM_TITLE = r'id="title_bar_left"[^>]*>([^<]*)'
_FILM_STRONG = r'(?s)id="article".*?<span[^>]*>\s*<strong[^>]*>([^<]*)'
_FILM_PARTNER = r'(?s)<div[^>]*\bclass="application"[^>]*>\s*<h1[^>]*>(.*?)</h1>'

FIELD_RULES = (
    *_both(ASIA_WORLD_EXPO, "name", r"(?s)<h3[^>]*>([^<]*)</h3>"),
    FieldRule(FILM_ARCHIVE, "en", "name", 1, _FILM_TITLE, "Film Screenings"),
    FieldRule(FILM_ARCHIVE, "zh", "name", 1, _FILM_TITLE, "電影放映"),
    FieldRule(FILM_ARCHIVE, "en", "name", 2, _FILM_STRONG),
    FieldRule(FILM_ARCHIVE, "zh", "name", 2, _FILM_STRONG),
    FieldRule(FILM_ARCHIVE, "en", "name", 3, _FILM_PARTNER),
    FieldRule(FILM_ARCHIVE, "zh", "name", 3, _FILM_PARTNER),
    *_both(MUSEUM_OF_ART, "name", r'(?s)id="single-exhibition-hero-banner".*?<h1[^>]*>([^<]*)</h1>'),
    *_both(MUSEUM_OF_ART, "description", r'(?s)id="single-exhibition-content".*?<[pP]\b[^>]*>(.*?)' + PARAGRAPH_END),
    *_both(TOURISM_BOARD, "name", r"<title[^>]*>([^<]*)</title>"),
    *_both(TRADE_COUNCIL, "name", r'<font[^>]*\bcolor="black"[^>]*>([^<]*)'),
    *_both(TAIKOO, "name", r'(?s)id="mainform".*?<h1[^>]*>(.*?)</h1>'),
    *_both(TAI_KWUN, "name",
           r'(?s)id="programme-content".*?<section\b.*?<span[^>]*>([^<]*)</span>',
           r'(?s)class="page-title-section container "[^>]*>.*?<span[^>]*>([^<]*)</span>'),
    *_both(TAI_KWUN, "description",
           r"(?s)<article\b[^>]*>\s*<div[^>]*>.*?</div>\s*<div[^>]*>(.*?)</article>"),
    *_both(WEST_KOWLOON, "name", r"(?s)<header\b.*?<h1[^>]*>([^<]*)</h1>"),
    *_both(WEST_KOWLOON, "description", r"(?s)<article\b.*?<[pP]\b[^>]*>(.*?)" + PARAGRAPH_END),
    FieldRule(WEST_KOWLOON, "en", "location", 1, _DL.format("Venue")),
    FieldRule(WEST_KOWLOON, "zh", "location", 1, _DL.format("地點")),
    FieldRule(WEST_KOWLOON, "en", "date_text", 1, _DL.format("Date")),
)

LABEL_RULES = (
    LabelRule(TOURISM_BOARD, "date_text", "date"),
    LabelRule(TOURISM_BOARD, "event_type_eng", "category(-ies)"),
    LabelRule(TOURISM_BOARD, "event_type_chi", "類別"),
    LabelRule(TOURISM_BOARD, "location_eng", "venue"),
    LabelRule(TOURISM_BOARD, "location_chi", "地點"),
    LabelRule(TOURISM_BOARD, "fee", "admission"),
    LabelRule(TOURISM_BOARD, "organiser_eng", "organiser"),
    LabelRule(TOURISM_BOARD, "organiser_chi", "主辦機構"),
    LabelRule(TRADE_COUNCIL, "date_text", "date:"),
    LabelRule(TRADE_COUNCIL, "description_eng", "description:"),
    LabelRule(TRADE_COUNCIL, "description_chi", "詳細資料:"),
    LabelRule(TRADE_COUNCIL, "event_type_eng", "format:"),
    LabelRule(TRADE_COUNCIL, "event_type_chi", "形式:"),
    LabelRule(TRADE_COUNCIL, "fee", "participation fee:"),
    LabelRule(TRADE_COUNCIL, "organiser_eng", "organiser:"),
    LabelRule(TRADE_COUNCIL, "organiser_chi", "主辦機構:"),
    LabelRule(PMQ, "date_text", "date"),
    LabelRule(PMQ, "location_eng", "venue"),
    LabelRule(PMQ, "location_chi", "場地"),
    LabelRule(PMQ, "fee", "fee (hkd)"),
    LabelRule(PMQ, "organiser_eng", "presented & organized"),
    LabelRule(PMQ, "organiser_chi", "主辦"),
    LabelRule(MUSEUM_OF_ART, "date_text", "Date", "contains"),
    LabelRule(MUSEUM_OF_ART, "location_eng", "Venue", "contains"),
    LabelRule(MUSEUM_OF_ART, "fee", "Fee", "contains"),
    LabelRule(MUSEUM_OF_ART, "location_chi", "地點", "contains"),
)

# Calendar header of PMQ: label of the link back, then the date label.
PMQ_HEADER = {"en": ("back to monthly calendar", "date"), "zh": ("返回查看活動一覧", "日期")}
PMQ_SENTINEL = {"en": "Know more about ", "zh": "有關 "}

TYPE_RULES = {
    ASIA_SOCIETY: (
        TypeRule("Performance", None, ("perform",)),
        TypeRule("Conversation", None, ("chat", "conversation")),
        TypeRule("Workshop", None, ("workshop", "diy")),
        TypeRule("Collection", None, ("collection",)),
    ),
    # the Chinese name of a class is a keyword of it as well
    THE_MILLS: (
        TypeRule("Performance", "表演", ("表演", "perform", "concert")),
        TypeRule("Conversation", "座談會", ("座談會", "talk", "conversation")),
        TypeRule("Workshop", "工作坊", ("工作坊", "workshop", "diy")),
        TypeRule("Exhibition", "展覽", ("展覽", "collection", "exhibition")),
        TypeRule("Sale", "展銷會", ("展銷會", "sale")),
        TypeRule("Class", "課程", ("課程", "class")),
    ),
}

# Real defaults: texts a record carries when its pages say nothing.
DEFAULTS = {
    ASIA_SOCIETY: {
        "event_type_eng": "Conversation / Others",
        "location_eng": "Online",
        "fee": "Free admission",
        "organiser_eng": "Asia Society Hong Kong Center",
    },
    ASIA_WORLD_EXPO: {},
    FILM_ARCHIVE: {},
    MUSEUM_OF_ART: {},
    TOURISM_BOARD: {},
    TRADE_COUNCIL: {"location_eng": "Online", "location_chi": "網上直播"},
    PMQ: {},
    TAIKOO: {},
    TAI_KWUN: {},
    THE_MILLS: {"fee": "Free admission"},
    WEST_KOWLOON: {},
}

# Fields that are published as N/A when missing; every other text field is published empty.
_LISTED = (
    "description_eng", "description_chi", "event_type_eng", "event_type_chi", "location_eng",
    "location_chi", "fee", "organiser_eng", "organiser_chi", "link_eng", "link_chi",
)
NOT_AVAILABLE = {
    TOURISM_BOARD: _LISTED,
    PMQ: _LISTED,
    TRADE_COUNCIL: ("description_eng", "description_chi", "fee", "organiser_eng", "organiser_chi"),
    THE_MILLS: ("event_type_eng", "event_type_chi", "location_eng", "location_chi"),
}


def published_defaults() -> dict[str, dict[str, str]]:
    """Defaults with the markers for missing values, for output to readers that expect text."""
    from ..schema import TEXT_FIELDS

    table = {}
    for source, known in DEFAULTS.items():
        listed = NOT_AVAILABLE.get(source, ())
        table[source] = {name: known.get(name, "N/A" if name in listed else "") for name in TEXT_FIELDS}
    return table
