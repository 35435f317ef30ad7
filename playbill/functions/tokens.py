"""Work on the token list of a page: an array per row, so no token ever leaves its task.

Positions from ``array_position`` are one-based and 0 when absent, ``get`` is zero-based; the
element behind a label is therefore ``get(tokens, position)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .html import rest
from .text import ENTITIES, NBSP, WORD, none_if, replace_each

# What the sources delete from a token, in this order. LEAD deletes one leading blank.
LEAD = None
BLANKS_FIRST = (("  ", ""), ("\n", ""), LEAD)
BREAKS_FIRST = (("\n", ""), ("\t", ""), ("  ", ""), LEAD)
HALVED_BLANKS = (("  ", " "), ("  ", ""), ("\n", ""), LEAD)
BLANKS_TWICE = (("  ", ""), ("\n", ""), (NBSP, ""), LEAD, ("  ", ""))


def clean_tokens(tokens: Column, steps=BLANKS_FIRST, keep_blank: bool = False) -> Column:
    """Clean each token, then drop the empty ones (and single blanks unless they are kept)."""

    def clean(token: Column) -> Column:
        for step in steps:
            if step is LEAD:
                token = F.regexp_replace(token, "^ ", "")
            else:
                token = replace_each(token, [step])
        return token

    dropped = [""] if keep_blank else ["", " "]
    return F.filter(F.transform(tokens, clean), lambda token: ~token.isin(dropped))


# Stand-ins for escaped brackets while tags are still in the text.
_OPEN, _CLOSE = "\ue000", "\ue001"


def tokens_of(fragment: Column, steps=BLANKS_FIRST, keep_blank: bool = False) -> Column:
    """Cleaned text nodes of a piece of HTML.

    The same as cleaning every text node, but on the whole fragment where that gives the same: what
    comes before the leading blank before it is cut at its tags, the leading blank with its tag.
    """
    before, after = steps[: steps.index(LEAD)], steps[steps.index(LEAD) + 1 :]
    standing = [("&lt;", _OPEN), ("&gt;", _CLOSE)]
    named = standing + [pair for pair in ENTITIES if pair[0] not in dict(standing)]
    text = F.when(fragment.contains("&"), replace_each(fragment, named)).otherwise(fragment)
    # an empty tag in front, so that the first node has one too
    nodes = F.split(F.concat(F.lit("<>"), replace_each(text, before)), "<[^>]*> ?")
    if after:
        nodes = F.transform(nodes, lambda node: replace_each(node, after))
    escaped = fragment.contains("&") | fragment.contains(_OPEN) | fragment.contains(_CLOSE)
    nodes = F.when(escaped, F.transform(nodes, lambda node: F.translate(node, _OPEN + _CLOSE, "<>"))).otherwise(nodes)
    for dropped in ("",) if keep_blank else ("", " "):
        nodes = F.array_remove(nodes, F.lit(dropped))
    return nodes


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def position(tokens: Column, value: str) -> Column:
    return F.array_position(tokens, F.lit(value)).cast("int")


def after_label(tokens: Column, lowered: Column, *aliases: str) -> Column:
    """Token behind the first hit of an alias; of several aliases on the page the last one counts."""
    values = []
    for alias in reversed(aliases):
        at = position(lowered, alias)
        values.append(F.when(at > 0, F.get(tokens, at)))
    return F.coalesce(*values)


def after_contained_label(clusters: Column, label: str) -> Column:
    """Cluster behind the last cluster that contains the label."""
    following = rest(clusters)
    pairs = F.zip_with(
        clusters, following, lambda text, value: F.struct(text.alias("text"), value.alias("value"))
    )
    hits = F.filter(pairs, lambda pair: pair["text"].contains(label))
    return F.try_element_at(hits, F.lit(-1))["value"]


def calendar_header(tokens: Column, lowered: Column, alias: str, marker: str) -> tuple[Column, Column]:
    """Name and type behind a calendar link.

    The marker as second token means there is a name only; otherwise the type precedes the name.
    """
    at = position(lowered, alias)
    one, two = F.get(tokens, at), F.get(tokens, at + 1)
    name_only = F.coalesce(F.lower(two) == marker, F.lit(False))
    name = F.when(at > 0, F.when(name_only, one).otherwise(two))
    kind = F.when((at > 0) & ~name_only, one)
    return name, kind


def join_tokens(tokens: Column, glue: str, closed: bool = False) -> Column:
    """One text of all tokens; a closed text also ends with the glue. NULL when there are none."""
    text = none_if(F.array_join(tokens, glue))
    return F.concat(text, F.lit(glue)) if closed else text


def take_until(tokens: Column, sentinel: str, glue: str = "\n") -> Column:
    """Tokens up to a sentinel, joined. The first token belongs to the text in any case."""
    at = position(rest(tokens), sentinel)
    kept = F.when(at > 0, at).otherwise(F.size(tokens))
    return none_if(F.array_join(F.slice(tokens, F.lit(1), kept), glue))


def first_token(tokens: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(tokens, test), F.lit(0))


def first_word_token(tokens: Column) -> Column:
    """First token with a letter or digit of any script."""
    return first_token(tokens, lambda token: token.rlike(WORD))


def first_price_token(tokens: Column) -> Column:
    """First token with a dollar sign; it decides, and gives nothing when it has a full stop."""
    priced = first_token(tokens, lambda token: token.contains("$"))
    return F.when(~priced.contains("."), priced)


def venue_sentence(tokens: Column, *words: str) -> Column:
    """First sentence that speaks of the venue."""
    sentences = F.flatten(F.transform(tokens, lambda token: F.split(token, "[.!?]")))
    return first_token(
        sentences, lambda text: reduce(or_, [text.contains(word) for word in words])
    )


def place_and_fee(nodes: Column) -> tuple[Column, Column]:
    """Location and fee by the number of nodes; a first node with ``Free`` is the fee alone."""
    free = F.get(nodes, F.lit(0)).contains("Free")
    location = F.when(~free & F.size(nodes).isin(1, 2), F.get(nodes, F.lit(0)))
    fee = F.when(free, F.get(nodes, F.lit(0))).when(F.size(nodes) == 2, F.get(nodes, F.lit(1)))
    return location, fee


def count_of(text: Column, piece: str) -> Column:
    """How often a piece occurs in a text."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))
    return F.floor(gone / len(piece))
