"""Cutting regions, attributes and text nodes out of raw HTML with native expressions.

Patterns avoid repeated groups over long spans, which would make the JVM's matcher recurse; a lazy
``.*?`` or a negated class runs in a loop. Cut a region once, then work on the region.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, functions as F

from .text import ENTITIES, none_if, replace_each

HREF = r'<a\s(?:[^>]*?\s)?href="([^"]*)"'


def _any_case(name: str) -> str:
    """Pattern of a tag name in any case; a class per letter fails faster than a caseless match."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name.lower())


def _at_border(border: str, name: str) -> str:
    """Pattern of an attribute's name behind a border. A word border is looked for where the first
    letter fits, not at every character."""
    spelt = _any_case(name)
    if border != r"\b" or not name[0].isalpha():
        return border + spelt
    first = _any_case(name[0])
    return rf"{first}(?<=\b{first}){spelt[len(first):]}"


_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CAPTURED = re.compile(r'(?:(\\[bs])|(?<![\\A-Za-z-]))([a-z-]+)="\(\[\^"\]\*\)"')
_FIXED = re.compile(r'(?:(\\[bs])|(?<![\\A-Za-z-]))([a-z-]+)="([^"()\[\]*?\\]+)"')
_TAG = re.compile(r"(?<![?(])<(/?\??)([a-z][a-z0-9]*)")


@lru_cache(maxsize=None)
def tolerant(pattern: str) -> tuple[str, bool]:
    """A pattern in plain HTML, written for HTML as it comes: tags and attribute names in any case,
    values in double, single or no quotes. Says too whether it captures the value of an attribute,
    which then comes with its quotes (see ``attribute_value``).

    Patterns name a value as name="value", and capture one as name="([^"]*)".
    """

    def fixed(match: re.Match) -> str:
        border, name, value = match.groups()
        forms = [f'"{value}"', f"'{value}'"] + ([] if " " in value else [rf"{value}(?=[\s>])"])
        return rf"{_at_border(border or '', name)}\s*=\s*(?:{'|'.join(forms)})"

    found = _FIXED.sub(fixed, pattern)
    found = _CAPTURED.sub(lambda m: rf"{_at_border(m[1] or '', m[2])}\s*=\s*{_VALUE}", found)
    return _TAG.sub(lambda m: f"<{m[1]}{_any_case(m[2])}", found), bool(_CAPTURED.search(pattern))


def attribute_value(raw: Column) -> Column:
    """The value of an attribute without its quotes, the references of markup decoded."""
    return replace_each(F.regexp_replace(raw, r"""^["']|["']$""", ""), ENTITIES)


# One alternative behind one opening bracket: every other character is passed at once.
_INVISIBLE = "(?s)<(?:{0}\\b.*?</{0}|{1}\\b.*?</{1}|!--.*?--)>".format(_any_case("script"), _any_case("style"))


# A paragraph ends where it is closed or, as HTML has it, where the next one begins. The second end
# also keeps the match short on pages that close none.
PARAGRAPH_END = r"(?=</?[pP]\b|\z)"
PARAGRAPH = rf"(?s)<[pP]\b[^>]*>(.*?){PARAGRAPH_END}"


def drop_invisible(html: Column) -> Column:
    """Without scripts, styles and comments."""
    return F.regexp_replace(html, _INVISIBLE, "")


def first_group(html: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, NULL when there is none or it is empty."""
    pattern, value = tolerant(pattern)
    found = F.regexp_extract(html, pattern, group)
    return none_if(attribute_value(found) if value else found)


def first_present(html: Column, *patterns: str) -> Column:
    """Fallback chain: the first pattern that yields something wins."""
    return F.coalesce(*[first_group(html, pattern) for pattern in patterns])


def all_groups(html: Column, pattern: str, group: int = 1) -> Column:
    pattern, value = tolerant(pattern)
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(group))
    return F.transform(found, attribute_value) if value else found


def link_targets(html: Column) -> Column:
    """The href of every anchor, in page order."""
    return all_groups(html, HREF)


def paragraphs(html: Column) -> Column:
    """Inner HTML of every paragraph."""
    return all_groups(html, PARAGRAPH)


def text_nodes(fragment: Column) -> Column:
    """The texts between the tags, in page order and as they are."""
    return F.split(fragment, r"<[^>]*>")


def meta_content(html: Column, attribute: str, name: str) -> Column:
    """Content of a meta element, whichever order its attributes have."""
    key = rf'{attribute}="{name}"'
    return first_present(
        html,
        rf'<meta\s[^>]*?{key}[^>]*?\scontent="([^"]*)"',
        rf'<meta\s[^>]*?content="([^"]*)"[^>]*?\s{key}',
    )


def definition(html: Column, label: str) -> Column:
    """Value of a definition list entry, by its label."""
    return first_group(html, rf"(?s)<dt[^>]*>\s*{label}\s*</dt>\s*<dd[^>]*>(.*?)</dd>")


def rest(items: Column, start: int = 2) -> Column:
    """Elements from a one-based position on, the array evaluated once."""
    return F.slice(items, F.lit(start), F.lit(1 << 30))


CONTAINERS = ("div", "main", "section", "form", "ul")


_START = "\ue002"  # stands behind every start tag that matches
# Depth and length of an element in one number, depth times this and length: with a struct the
# interpreted expressions would compute both twice.
_DEEP = 1 << 40


def _size(state: Column) -> Column:
    return (state % _DEEP).cast("int")


def element_bodies(html: Column, start_tag: str, tag: str = "div") -> Column:
    """Inner HTML of every element whose start tag matches, closed where its own tag closes.

    The text after each start tag is cut before every further start or end of the same tag name;
    adding up the pieces until the depth returns to zero gives the length of the body. It is looked
    for up to the next matching start tag, and in the whole rest of the page only for an element
    with another one inside. Higher-order functions are interpreted, so every part is evaluated
    once only.
    """

    def add(state: Column, piece: Column) -> Column:
        size = F.length(piece)
        return (
            F.when(state < _DEEP, state)
            .when(piece.startswith("/"), F.when(state < 2 * _DEEP, state - _DEEP).otherwise(state - _DEEP + size + 1))
            .when(piece.startswith(" "), state + size - 1)
            .otherwise(state + _DEEP + size + 1)
        )

    def end(tail: Column) -> Column:
        # the blank in front keeps the first piece free of tags: all others begin with one, its
        # bracket gone
        pieces = F.split(F.concat(F.lit(" "), tail), rf"<(?=/?{_any_case(tag)}\b)")
        return F.aggregate(pieces, F.lit(_DEEP), add)

    def bodies(tails: Column) -> Column:
        def body(tail: Column, index: Column) -> Column:
            def cut(found: Column) -> Column:
                whole = F.array_join(F.filter(tails, lambda _, i: i > index), "")
                longer = F.element_at(F.transform(F.array(whole), lambda t: F.substr(t, F.lit(1), _size(end(t)))), 1)
                return F.when((found >= _DEEP) & (index + 2 < F.size(tails)), longer).otherwise(F.substr(tail, F.lit(1), _size(found)))

            return F.element_at(F.transform(F.array(end(tail)), cut), 1)

        return F.transform(rest(tails), body)

    marked = F.regexp_replace(html, tolerant(start_tag)[0], f"$0{_START}")
    found = F.element_at(F.transform(F.array(F.split(marked, _START)), bodies), 1)
    return F.transform(found, lambda body: F.replace(body, F.lit(_START), F.lit("")))


def element_of(html: Column, attribute: str) -> Column:
    """Inner HTML of the elements with an attribute, whatever container they are, up to their own
    ends and without navigation, header and footer in them.

    One pattern finds the start tags of all containers and marks them with their names; the text
    after a start tag is cut at the tags of all containers once, and only those of its own name count.
    """
    names = "|".join(_any_case(name) for name in CONTAINERS)
    longest = max(len(name) for name in CONTAINERS)
    start_tag = rf"<({names})\b[^>]*\b{tolerant(attribute)[0]}[^>]*>"

    def body(parts: Column, at: Column) -> Column:
        """parts: the text before the first start tag, then a name and the text behind it, and so on."""
        tail = F.when(at + 2 == F.size(parts), F.get(parts, at + 1)).otherwise(F.array_join(F.filter(parts, lambda _, i: (i > at) & (i % 2 == 0)), ""))

        def cut(known: Column) -> Column:
            def add(state: Column, piece: Column) -> Column:
                size, name = F.length(piece), known["name"]
                closed = F.when(state < 2 * _DEEP, state - _DEEP).otherwise(state - _DEEP + size + 1)
                return (
                    F.when(state < _DEEP, state)
                    .when(piece.startswith(" "), state + size - 1)
                    .when(piece.startswith("/") & F.lower(F.substring(piece, 2, longest)).startswith(name), closed)
                    .when(F.lower(F.substring(piece, 1, longest)).startswith(name), state + _DEEP + size + 1)
                    .otherwise(state + size + 1)
                )

            # the blank in front keeps the first piece free of tags: all others begin with one, its
            # bracket gone
            pieces = F.split(F.concat(F.lit(" "), known["tail"]), rf"<(?=/?(?:{names})\b)")
            return F.substr(known["tail"], F.lit(1), _size(F.aggregate(pieces, F.lit(_DEEP), add)))

        # name and text as items of an array, so that they are made once
        known = F.array(F.struct(F.lower(F.get(parts, at)).alias("name"), tail.alias("tail")))
        return F.element_at(F.transform(known, cut), 1)

    def bodies(parts: Column) -> Column:
        places = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: body(parts, at))

    marked = F.regexp_replace(html, f"({start_tag})", f"$1{_START}$2{_START}")
    found = F.element_at(F.transform(F.array(F.split(marked, _START)), bodies), 1)
    return F.regexp_replace(F.array_join(found, " "), r"(?is)<(nav|header|footer)\b.*?</\1\s*>", " ")
