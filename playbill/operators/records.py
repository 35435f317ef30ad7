"""Event records: one form for all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fee_amount
from ..schema import EVENT_COLUMNS, TEXT_FIELDS

# What the fetching side adds to a row and no record keeps.
TRANSPORT = (
    "depth",
    "download_timeout",
    "download_slot",
    "download_latency",
    "redirect_times",
    "redirect_ttl",
    "redirect_urls",
    "redirect_reasons",
)


def drop_transport(df: DataFrame) -> DataFrame:
    return df.drop(*TRANSPORT)


def valid_header(nodes: Column) -> Column:
    """A page is a record page only when its header has more than two text nodes."""
    return F.size(nodes) > 2


def default_of(field: str, defaults: dict[str, dict[str, str]]) -> Column:
    """Default of a field by the row's source, NULL where there is none.

    A handful of literals in the projection: a join on the source would bring all records of a
    source into one task.
    """
    sources: dict[str, list[str]] = {}
    for source, row in defaults.items():
        if row.get(field) is not None:
            sources.setdefault(row[field], []).append(source)
    chosen = F.lit(None).cast("string")
    for value, names in sources.items():
        chosen = F.when(F.col("source").isin(names), F.lit(value)).otherwise(chosen)
    return chosen


def conform(events: DataFrame, defaults: dict[str, dict[str, str]]) -> DataFrame:
    """The fixed record: missing columns added, defaults of the source filled in."""
    names = set(events.columns)
    filled = {
        name: F.coalesce(F.col(name), default_of(name, defaults)) if name in names else default_of(name, defaults)
        for name in TEXT_FIELDS
    }
    missing = {
        "start_date": F.lit(None).cast("date"),
        "end_date": F.lit(None).cast("date"),
        "dates": F.lit(None).cast("array<date>"),
        "fetch_date": F.lit(None).cast("timestamp"),
        "extract_ok": F.lit(True),
    }
    extra = {name: column for name, column in missing.items() if name not in names}
    events = events.withColumns({**filled, **extra})
    return events.withColumn("fee_amount", fee_amount(F.col("fee"))).select(*EVENT_COLUMNS)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources in one table, by column name."""
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), frames)
