"""Dates: single dates, ranges in many forms, and mentions in free text.

Results never depend on the clock: ``as_of`` is the day the job counts as today.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .text import squeeze

# The English month names, abbreviated or in full.
MONTH = (
    "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?"
    "|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)
# The English weekday names, in full and abbreviated.
WEEKDAY = (
    "(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
    "|Mon|Tues|Tue|Wed|Thurs|Thur|Thu|Fri|Sat|Sun)"
)

# The shape of a date and its format. Looking at the shape first means that only a
# date of the right shape is parsed, so the parser hardly ever has to fail.
SHAPES = (
    (r"\d{1,2} [A-Za-z]{3} \d{4}", "d MMM yyyy"),
    (r"\d{1,2} [A-Za-z]{4,9} \d{4}", "d MMMM yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"),
    (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
    (r"\d{4}\.\d{1,2}\.\d{1,2}", "yyyy.M.d"),
    (r"\d{4}年 ?\d{1,2}月 ?\d{1,2}日", "yyyy年[ ]M月[ ]d日"),
)
# One look and one parser for all: a section in brackets is passed over where it does not fit.
_ANY_SHAPE = f"^(?:{'|'.join(shape for shape, _ in SHAPES)})$"
_ANY_FORMAT = "".join(f"[{pattern}]" for _, pattern in SHAPES)

# a look ahead at the first character spares all other places the alternatives
_WEEKDAY_NOTE = rf"(?=[(MTWFS])(?:\([^)]*\)|\b{WEEKDAY}\b\.?,?)"
_BARE_MONTH = rf"(?i)^{MONTH} \d{{4}}$"
_SEPARATOR = r"(?=[ –—])(?: ?[–—] ?| - | [tT][oO] )"  # in a squeezed text
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
MENTION = rf"(?=[0-9JFMASOND])\b(?:{_DAY}\s*-\s*{_DAY}\s+|{_DAY}\s+)?{MONTH}\b(?:,?\s*\d{{4}}\b)?"


def as_of_date(as_of: datetime.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def parse_date(text: Column) -> Column:
    """Date of a squeezed text in one of the known formats, NULL when it is none."""
    return F.when(text.rlike(_ANY_SHAPE), F.try_to_date(text, _ANY_FORMAT))


def without_weekday(text: Column) -> Column:
    """Without bracketed parts and weekday names."""
    return squeeze(F.regexp_replace(text, _WEEKDAY_NOTE, " "))


def with_date_range(
    df: DataFrame,
    text: str,
    as_of: datetime.date | Column,
    single_end: str | Column = "open",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Add the start and end date that a text such as ``5 - 26 Aug, 2020`` speaks of.

    ``single_end`` says what the end of a single date is: ``same`` (the date itself) or ``open``
    (NULL). The steps are columns of their own, so that each is computed once.
    """
    kept = [name for name in df.columns if name not in (start, end)]
    today = as_of_date(as_of)
    same = F.lit(single_end == "same") if isinstance(single_end, str) else single_end == "same"
    year_of_today = F.year(today).cast("string")
    day_only, no_year, slashed = r"^\d{1,2}$", rf"(?i)^(?:\d{{1,2}} )?{MONTH}$", r"^\d{1,2}/\d{1,2}$"

    # no weekday, no comma, one-sided words kept apart, every separator a bar
    bare = squeeze(F.regexp_replace(text, rf"{_WEEKDAY_NOTE}|,", " "))
    bare = F.regexp_replace(bare, r"^(\d{1,2})-(\d{1,2} [A-Za-z])", r"$1 - $2")
    df = df.withColumn("_bare", F.regexp_replace(bare, _SEPARATOR, "|"))
    one_sided = r"^(?i:(From|Until)) "
    word = F.when(F.col("_bare").rlike(one_sided), F.lower(F.regexp_extract("_bare", one_sided, 1)))
    df = df.withColumn("_word", word.otherwise(F.lit("")))
    body = F.when(F.col("_word") == "", F.col("_bare")).otherwise(F.regexp_replace("_bare", one_sided, ""))
    df = df.withColumn("_parts", F.split(body, r"\|"))

    # the side that says less takes month and year from the other one
    df = df.withColumn("_first", F.get("_parts", F.lit(0)))
    df = df.withColumn("_last", F.get("_parts", F.lit(1)))
    first, last = F.col("_first"), F.col("_last")
    month_year = F.regexp_extract(last, r"^\d{1,2} (.+)$", 1)
    year = F.regexp_extract(last, r"(\d{4})$", 1)
    has_year = F.coalesce(last.rlike(r"\d{4}$"), F.lit(False))
    df = df.select(
        "*",
        F.when(has_year & first.rlike(day_only), F.concat_ws(" ", first, month_year))
        .when(has_year & first.rlike(no_year), F.concat_ws(" ", first, year))
        .when(first.rlike(slashed), F.concat(first, F.lit("/"), year_of_today))
        .otherwise(first)
        .alias("_from"),
        F.when(first.rlike(r"^\d{4}\.\d{2}\.\d{2}$"),
               F.when(last.rlike(day_only), F.concat(F.substring(first, 1, 8), last))
               .when(last.rlike(r"^\d{1,2}\.\d{1,2}$"), F.concat(F.substring(first, 1, 5), last))
               .otherwise(last))
        .when(last.rlike(slashed), F.concat(last, F.lit("/"), year_of_today))
        .otherwise(last)
        .alias("_to"),
    )

    # a bare month starts on its first day and ends on its last
    df = df.select(
        "*",
        F.col("_from").rlike(_BARE_MONTH).alias("_from_month"),
        F.col("_to").rlike(_BARE_MONTH).alias("_to_month"),
    )
    dated_from = F.when(F.col("_from_month"), F.concat(F.lit("1 "), "_from")).otherwise(F.col("_from"))
    dated_to = F.when(F.col("_to_month"), F.concat(F.lit("1 "), "_to")).otherwise(F.col("_to"))
    df = df.select("*", dated_from.alias("_from_text"), dated_to.alias("_to_text"))
    df = df.select(
        "*",
        parse_date(F.col("_from_text")).alias("_from_date"),
        parse_date(F.col("_to_text")).alias("_to_date"),
    )

    starts_now = first.rlike(r"(?i)(?=n)\bnow\b")
    open_end = last.rlike(r"(?i)(?=[no])\b(?:now|onwards?)\b")
    single = F.size("_parts") == 1
    single_last = F.when(F.col("_from_month"), F.last_day("_from_date")).otherwise(F.col("_from_date"))
    result = {
        start: F.when(F.col("_word") == "until", F.when(F.col("_from_date").isNotNull(), today))
        .when(starts_now, today)
        .otherwise(F.col("_from_date")),
        end: F.when(F.col("_word") == "from", F.lit(None).cast("date"))
        .when(F.col("_word") == "until", F.col("_from_date"))
        .when(open_end, F.lit(None).cast("date"))
        .when(~single & F.col("_to_month"), F.last_day("_to_date"))
        .when(~single, F.col("_to_date"))
        .when(same & ~starts_now, single_last),
    }
    return df.withColumns(result).select(*kept, start, end)


def mentions(text: Column) -> Column:
    """Every mention of a date in a free text, without ordinal endings."""
    found = F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))
    return F.transform(found, lambda m: F.regexp_replace(m, r"(\d)(?:st|nd|rd|th)", "$1"))


# Years an event may be in. A longer number is none, and neither is half a telephone number: two
# groups of four digits, unless both look like years of this century.
YEARS = (2001, 2100)
_YEAR = r"(?=\d)(?<!\d)\d{4}(?!\d)"
_TELEPHONE = r"(?=\d)(?<!\d)(?!20\d\d[ -]20\d\d(?!\d))\d{4}[ -]\d{4}(?!\d)"


def fill_year(text: Column, url: Column, as_of: datetime.date | Column, years: tuple[int, int] = YEARS) -> Column:
    """Year for mentions without one: the largest number of text and address that may be a year.

    That is a whole number of four digits within ``years``, no half of a telephone number; without
    one the current year counts.
    """

    def found(source: Column) -> Column:
        bare = F.regexp_replace(source, _TELEPHONE, " ")
        numbers = F.transform(F.regexp_extract_all(bare, F.lit(_YEAR), F.lit(0)), lambda n: n.cast("int"))
        return F.array_max(F.filter(numbers, lambda n: n.between(*years)))

    return F.coalesce(F.greatest(found(text), found(url)), F.year(as_of_date(as_of)))


def with_mentioned_dates(
    df: DataFrame,
    text: str,
    url: str,
    as_of: datetime.date | Column,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Add the earliest and the latest date a free text mentions; a single date has no end."""
    df = df.withColumn("_mentions", mentions(F.col(text)))
    df = df.withColumn("_year", fill_year(F.col(text), F.col(url), as_of).cast("string"))
    month = rf"({MONTH})"

    def dates(mention: Column) -> Column:
        days = F.regexp_extract_all(mention, F.lit(r"\b(\d{1,2})\b"), F.lit(1))
        days = F.when(F.size(days) > 0, days).otherwise(F.array(F.lit("1")))
        year = F.regexp_extract(mention, r"(\d{4})$", 1)
        year = F.when(year != "", year).otherwise(F.col("_year"))
        return F.transform(
            days, lambda day: F.concat_ws(" ", day, F.regexp_extract(mention, month, 1), year)
        )

    texts = F.flatten(F.transform("_mentions", dates))
    df = df.withColumn("_dates", F.array_compact(F.transform(texts, parse_date)))
    return df.withColumns(
        {
            start: F.array_min("_dates"),
            end: F.when(F.size("_dates") > 1, F.array_max("_dates")),
        }
    ).drop("_mentions", "_year", "_dates")


def screening_dates(texts: Column, as_of: datetime.date | Column) -> Column:
    """All dates of a list of texts, a missing year being the current one."""
    year = F.year(as_of_date(as_of)).cast("string")

    def date(text: Column) -> Column:
        bare = without_weekday(text)
        return parse_date(F.when(bare.rlike(r"^\d{1,2}/\d{1,2}$"), F.concat_ws("/", bare, year)).otherwise(bare))

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(texts, date))))


def date_tokens(tokens: Column) -> Column:
    """Only the tokens that are dates: times begin with a digit, dates with a weekday."""
    return F.filter(tokens, lambda token: ~token.rlike("^[0-9]"))
