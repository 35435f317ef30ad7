"""Event classes by keywords in the title. The rules become one expression, no join is needed."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class TypeRule(NamedTuple):
    type_eng: str
    type_chi: str | None
    keywords: tuple[str, ...]


def classify(title: Column, rules: Iterable[TypeRule]) -> Column:
    """English class of the last rule with a keyword in the lower-cased title, NULL without one."""
    lowered = F.lower(title)
    chosen = None
    for rule in reversed(list(rules)):
        hit = reduce(or_, [lowered.contains(word) for word in rule.keywords])
        label = F.lit(rule.type_eng)
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return chosen


def translate_type(type_eng: Column, rules: Iterable[TypeRule]) -> Column:
    """Chinese name of an English class."""
    chosen = None
    for rule in rules:
        test, label = type_eng == rule.type_eng, F.lit(rule.type_chi)
        chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
    return chosen
