"""Links: from pages to the addresses of further pages. All but the de-duplication are narrow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html as H


def extract_links(pages: DataFrame, region: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per anchor of a page (or of a region of it): position and target."""
    targets = H.link_targets(F.col("html") if region is None else region)
    return pages.select(*keep, "page_id", F.posexplode(targets).alias("pos", "link"))


def absolutise(df: DataFrame, base: str | Column, link: str = "link") -> DataFrame:
    """Put the base before every link that does not have a scheme yet."""
    base = F.lit(base) if isinstance(base, str) else base
    whole = F.when(F.col(link).rlike("(?i)^https?://"), F.col(link))
    return df.withColumn(link, whole.otherwise(F.concat(base, F.col(link))))


def same_host(df: DataFrame, host: str | Column, link: str = "link") -> DataFrame:
    """Only links to one host."""
    return df.where(F.regexp_extract(link, "^https?://([^/?#]*)", 1) == host)


def next_pages(pages: DataFrame) -> DataFrame:
    """The ``next`` link of every list page, NULL on the last one: the edges of ``page_chain``."""
    anchor = H.first_group(F.col("html"), r'(<a\s[^>]*\bclass="next"[^>]*>)')
    return pages.select("source", "url", H.first_group(anchor, r'\shref="([^"]*)"').alias("next_url"))


def every_second(df: DataFrame, position: str = "pos") -> DataFrame:
    """Cards link twice in a row: keep the first link of each pair."""
    return df.where(F.col(position) % 2 == 0)


def first_links(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key, the first in the given order.

    An aggregate and not a window: copies meet within their task before the shuffle, so a link
    that a third of all pages carry still arrives once per task.
    """
    rest = [name for name in df.columns if name not in (*keys, *order)]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def card_links(pages: DataFrame, card: str, marker: str, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Candidate links of the dated cards of a page: addresses with a prefix, no images.

    Every candidate of a card comes with its rank, so that refused ones can be taken out by a join
    before ``first_links`` picks the card's link.
    """
    bodies = F.filter(H.element_bodies(F.col("html"), card), lambda body: body.contains(marker))
    cards = pages.select(*keep, "page_id", F.posexplode(bodies).alias("card", "body"))
    found = H.all_groups(F.col("body"), rf'({prefix}[^"]*)"')
    candidates = F.filter(found, lambda link: ~link.contains(".jpg"))
    return cards.select(*keep, "page_id", "card", F.posexplode(candidates).alias("rank", "link"))


def without_denied(df: DataFrame, denied: DataFrame | Sequence[str], link: str = "link") -> DataFrame:
    """Drop denied links: a short list becomes a filter, a table (column ``url``) an anti join.

    No broadcast is forced on the table, as it may be long.
    """
    if isinstance(denied, DataFrame):
        return df.join(denied.select(F.col("url").alias(link)), link, "left_anti")
    return df.where(~F.col(link).isin(list(denied)))


def first_of_card(candidates: DataFrame, keys: tuple[str, ...] = ("page_id", "card")) -> DataFrame:
    return first_links(candidates, keys, ("rank",))
