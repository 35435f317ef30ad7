"""Field extraction by rules. Rules are rows of data; they become one narrow projection."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html as H
from ..functions import tokens as K
from ..functions.text import none_if


class FieldRule(NamedTuple):
    """A pattern for a field of a source's pages; the lowest priority that yields something wins."""

    source: str
    lang: str
    field: str
    priority: int
    pattern: str
    placeholder: str | None = None  # a value that means: look elsewhere


class LabelRule(NamedTuple):
    """A label and the field its value belongs to; of several aliases the last hit counts."""

    source: str
    field: str
    alias: str
    match: str = "exact"  # or contains


def rule_column(html: Column, rules: Iterable[FieldRule]) -> Column:
    """Fallback chain of the rules of one field."""
    values = []
    for rule in sorted(rules, key=lambda r: r.priority):
        value = H.first_group(html, rule.pattern)
        if rule.placeholder is not None:
            value = none_if(value, rule.placeholder)
        values.append(value)
    return F.coalesce(*values)


def extract_fields(pages: DataFrame, rules: Iterable[FieldRule], html: str = "html") -> DataFrame:
    """Add a column per field, filled by the rules of the row's source and language.

    No join and no pivot: a row meets only the patterns of its own source, within its task.
    """
    rules = list(rules)
    columns = {}
    for field in dict.fromkeys(rule.field for rule in rules):
        chosen = None
        groups = dict.fromkeys((r.source, r.lang) for r in rules if r.field == field)
        for source, lang in groups:
            mine = [r for r in rules if (r.source, r.lang, r.field) == (source, lang, field)]
            test = (F.col("source") == source) & (F.col("lang") == lang)
            value = rule_column(F.col(html), mine)
            chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
        columns[field] = chosen
    return pages.withColumns(columns)


def label_columns(
    tokens: Column, lowered: Column, rules: Iterable[LabelRule], source: str
) -> dict[str, Column]:
    """A column per field with the token behind its label."""
    rules = [rule for rule in rules if rule.source == source]
    columns = {}
    for field in dict.fromkeys(rule.field for rule in rules):
        mine = [rule for rule in rules if rule.field == field]
        exact = [rule.alias for rule in mine if rule.match == "exact"]
        contained = [rule.alias for rule in mine if rule.match == "contains"]
        values = [K.after_contained_label(tokens, alias) for alias in reversed(contained)]
        if exact:
            values.append(K.after_label(tokens, lowered, *exact))
        columns[field] = F.coalesce(*values)
    return columns


def zip_lists(df: DataFrame, keep: tuple[str, ...], position: str = "pos", **lists: Column) -> DataFrame:
    """Rows of parallel lists; a list that is too short leaves NULL, and ``aligned`` tells."""
    sizes = [F.size(column) for column in lists.values()]
    aligned = F.lit(True) if len(sizes) < 2 else F.least(*sizes) == F.greatest(*sizes)
    df = df.select(*keep, *[column.alias(name) for name, column in lists.items()], aligned.alias("aligned"))
    zipped = F.arrays_zip(*lists)
    df = df.select(*keep, "aligned", F.posexplode(zipped).alias(position, "_entry"))
    return df.select(*keep, position, *[F.col(f"_entry.{name}").alias(name) for name in lists], "aligned")
