"""Bringing the two language versions of an event together.

Both forms of pairing are one aggregation over the union of the two sides: a single shuffle, no
join. Copies of a page collapse within their task before the shuffle, so a page that is stored a
million times costs one row per task and the groups behind the shuffle stay tiny.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import DATE_FIELDS, HALF_FIELDS
from ..functions import html as H
from ..functions import text as X


def twin_url(url: Column, segment: str, other: str) -> Column:
    """Address of the other language version."""
    return F.replace(url, F.lit(segment), F.lit(other))


def event_id(source: Column, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", source, key), 256)


def overlay(first: str, second: str) -> list[Column]:
    """Fields of a record: the second page overwrites what it has, dates come from one side."""
    dated = F.col(f"{first}.start_date").isNotNull() | F.col(f"{first}.end_date").isNotNull()
    columns = []
    for name in HALF_FIELDS:
        one, two = F.col(f"{first}.{name}"), F.col(f"{second}.{name}")
        if name in DATE_FIELDS:
            value = F.when(F.coalesce(dated, F.lit(False)), one).otherwise(two)
        elif name == "fetch_date":
            value = F.coalesce(one, two)
        elif name == "extract_ok":
            value = F.coalesce(one, F.lit(True)) & F.coalesce(two, F.lit(True))
        else:
            value = F.coalesce(two, one)
        columns.append(value.alias(name))
    return columns


ORDER = ("fetched_at", "page_id", "pos")  # which of several fetches counts


def pair_halves(halves: DataFrame) -> DataFrame:
    """Half records to one row per (source, link_key) with the structs ``first`` and ``second``.

    ``hop`` 0 is the page a source starts with, ``hop`` 1 its other language version. Of several
    fetches of one page the earliest counts.
    """
    fields = F.struct(*ORDER, *HALF_FIELDS)
    sides = [F.min(F.when(F.col("hop") == hop, fields)) for hop in (0, 1)]
    return halves.groupBy("source", "link_key").agg(
        sides[0].alias("first"), sides[1].alias("second")
    )


def pair_languages(halves: DataFrame) -> DataFrame:
    """Records of the paired pages; without a twin the other language stays NULL."""
    paired = pair_halves(halves).where(F.col("first").isNotNull())
    return paired.select(
        event_id(F.col("source"), F.col("link_key")).alias("event_id"),
        "source",
        *overlay("first", "second"),
        F.col("second").isNotNull().alias("has_twin"),
    )


def merge_languages(halves: DataFrame) -> DataFrame:
    """Keyed merge of list entries: every id of either language is one record.

    The first English row of an id counts and takes the fields of the last Chinese row; an id only
    the Chinese list has is a record of its own, dated by its first row.
    """
    fields, order = F.struct(*HALF_FIELDS), F.struct(*ORDER)
    english, chinese = F.col("lang") == "en", F.col("lang") == "zh"
    merged = halves.groupBy("source", F.col("link_key").alias("event_id")).agg(
        F.min_by(fields, F.when(english, order)).alias("first"),
        F.max_by(fields, F.when(chinese, order)).alias("second"),
        F.min_by(F.struct(*DATE_FIELDS), F.when(chinese, order)).alias("dating"),
    )
    dated = [F.col(f"dating.{name}").alias(name) for name in DATE_FIELDS]
    kept = [F.col(f"second.{name}").alias(name) for name in HALF_FIELDS if name not in DATE_FIELDS]
    second = F.when(F.col("second").isNotNull(), F.struct(*dated, *kept))
    merged = merged.withColumn("second", second)
    known = F.col("first").isNotNull()
    columns = []
    for column, name in zip(overlay("first", "second"), HALF_FIELDS):
        if name in DATE_FIELDS:
            column = F.when(known, F.col(f"first.{name}")).otherwise(F.col(f"second.{name}")).alias(name)
        columns.append(column)
    return merged.select("event_id", "source", *columns, F.col("second").isNotNull().alias("has_twin"))


def fee_page_url(url: Column) -> Column:
    """The ticket page lies beside the page, whatever the scheme was."""
    return F.regexp_replace(F.regexp_replace(url, "^https?://", "https://"), "/[^/]*$", "/ticketinfo.html")


def lookup_fees(events: DataFrame, fees: DataFrame, url: str = "link_chi") -> DataFrame:
    """Fill missing fees from the ticket page beside the event's page.

    ``fees`` has (url, fee, fetched_at, page_id) and is brought to one row per address first, so
    the join never multiplies rows. Only events without a fee that have a ticket page's address go
    through the join; the others stay where they are. A directory with very many events is a skewed
    left side, which AQE splits.
    """
    pages = (
        fees.where("fee is not null")
        .groupBy(F.col("url").alias("_fee_key"))
        .agg(F.min(F.struct("fetched_at", "page_id", "fee")).alias("_found"))
    )
    keyed = events.withColumn("_fee_key", F.when(F.col("fee").isNull(), fee_page_url(F.col(url))))
    priced = keyed.where("_fee_key IS NOT NULL").join(pages, "_fee_key", "left")
    priced = priced.withColumn("fee", F.col("_found.fee")).select(*events.columns)
    return priced.unionByName(keyed.where("_fee_key IS NULL").select(*events.columns))


def fill_location(events: DataFrame, test: Column | None = None) -> DataFrame:
    """A location known in one language only serves for both."""
    test = F.lit(True) if test is None else test
    english, chinese = F.col("location_eng"), F.col("location_chi")
    return events.withColumns(
        {
            "location_eng": F.when(test, F.coalesce(english, chinese)).otherwise(english),
            "location_chi": F.when(test, F.coalesce(chinese, english)).otherwise(chinese),
        }
    )


def fee_of_ticket_page(html: Column) -> Column:
    """Price paragraph of a ticket page, without its label."""
    marked = X.paragraphs_with(H.paragraphs(html), "(?s)<span.*?<strong.*?票價：")
    nodes = F.flatten(F.transform(marked, lambda p: F.transform(F.split(p, "<[^>]*>"), X.unescape)))
    found = F.get(F.filter(nodes, lambda node: node.rlike(X.WORD)), F.lit(0))
    return X.none_if(X.drop_label(found, "票價："))
