"""Cleaning of texts, fee and organiser texts."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

NBSP = "\u00a0"
# A word character in any script; \w knows ASCII only.
WORD = r"[\p{L}\p{N}_]"

# The references replaced one after the other; the ampersand has to be last. All
# others are for decode_references, which leaves the five of markup to these.
ENTITIES = (
    ("&nbsp;", NBSP),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


_MARKUP = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#39;"}
# The named references of the HTML standard, as the standard library has them: those that end with
# a semicolon, and those that HTML also takes without one.
_NAMED = {name[:-1]: _MARKUP.get(value, value) for name, value in html5.items() if name.endswith(";")}
_BARE = {name: _MARKUP.get(value, value) for name, value in html5.items() if not name.endswith(";")}
# Numbers that do not stand for the character of their code: markup, and 128 to 159.
_NUMBERS = {str(ord(char)): reference for char, reference in _MARKUP.items()}
_NUMBERS |= {str(n): bytes([n]).decode("cp1252", "replace") for n in range(128, 160)}


def _table(values: dict[str, str]) -> Column:
    """A constant map: one expression to build, folded before the job runs."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


# A reference that the fixed ones above do not cover.
_OTHER = r"&(?!amp;|nbsp;|lt;|gt;|quot;|#39;|copy;|middot;)[#A-Za-z]"


def decode_page(html: Column) -> Column:
    """``decode_references`` for pages: those that have only the usual references are left alone."""
    return F.when(html.rlike(_OTHER), decode_references(html)).otherwise(html)


def decode_references(text: Column) -> Column:
    """Character references to characters, once: all named ones and all numbers.

    The characters of markup (& < > and both quotes) stay references, so that this can be done to a
    whole page before it is cut, once; ``unescape`` does these at the end. Each reference takes one
    look-up; what is none stays as it is.
    """
    number = r"^&#(?:([0-9]{1,9})|[xX]([0-9a-fA-F]{1,7}));?"

    def character(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        units = F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")
        return F.coalesce(F.try_element_at(_table(_NUMBERS), code.cast("string")), F.decode(F.unhex(units), "UTF-32"))

    def numbered(piece: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(piece, number, 1), F.regexp_extract(piece, number, 2)
        code = F.coalesce(F.nullif(decimal, F.lit("")), F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10)).cast("long")
        # the code is computed once for the two places that need it
        found = F.element_at(F.transform(F.array(code), character), 1)
        return F.concat(found, F.regexp_replace(piece, number, ""))

    def named(piece: Column) -> Column:
        closed, bare = r"^&([A-Za-z][A-Za-z0-9]*);", r"^&([A-Za-z]+)(?![A-Za-z0-9;=])"
        return F.coalesce(
            F.concat(F.try_element_at(_table(_NAMED), F.regexp_extract(piece, closed, 1)), F.regexp_replace(piece, closed, "")),
            F.concat(F.try_element_at(_table(_BARE), F.regexp_extract(piece, bare, 1)), F.regexp_replace(piece, bare, "")),
        )

    def decoded(piece: Column) -> Column:
        plain = ~piece.startswith("&") | piece.startswith("&amp;")
        value = F.when(piece.rlike(number), numbered(piece)).otherwise(named(piece))
        return F.when(plain, piece).otherwise(F.coalesce(value, piece))

    return F.array_join(F.transform(F.split(text, "(?=&)"), decoded), "")


def replace_each(text: Column, pairs) -> Column:
    for find, put in pairs:
        text = F.replace(text, F.lit(find), F.lit(put))
    return text


def none_if(text: Column, value: str = "") -> Column:
    """NULL in place of one value, the empty text at first. ``nullif`` names the text twice: within a
    condition, a lambda or a pushed filter all its patterns would run twice."""
    return F.get(F.array_remove(F.array(text), F.lit(value)), F.lit(0))


def once(text: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that names a computed text more than once, with the text computed once."""
    return F.get(F.transform(F.array(text), use), F.lit(0))


def unescape(text: Column) -> Column:
    """Named references to characters; a text without an ampersand is left alone. Names the text
    twice: a computed one goes through ``once``."""
    return F.when(text.contains("&"), replace_each(text, ENTITIES)).otherwise(text)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "</?[^>]*>", "")


def _clean(text: Column, nbsp: str, delete: tuple[str, ...]) -> Column:
    bare = strip_tags(text)
    # most texts have no reference: look at the text itself, so that the tags go only once
    bare = F.when(text.contains("&"), replace_each(bare, ENTITIES)).otherwise(bare)
    pairs = [("\n", ""), ("\t", ""), ("\r", " "), (NBSP, nbsp)]
    return replace_each(bare, pairs + [(piece, "") for piece in delete])


def clean_leaf(text: Column) -> Column:
    """``clean_text`` without outer blanks; empty where nothing is left."""
    return F.trim(_clean(text, " ", ()))


def joined_nodes(fragment: Column) -> Column:
    """The text nodes of a piece of HTML as ``clean_leaf`` has them, put together. A text node has no
    tag left to strip."""
    pairs = [("\n", ""), ("\t", ""), ("\r", " "), (NBSP, " ")]

    def clean(node: Column) -> Column:
        named = F.when(node.contains("&"), replace_each(node, ENTITIES)).otherwise(node)
        return F.trim(replace_each(named, pairs))

    return F.array_join(F.transform(F.split(fragment, "<[^>]*>"), clean), "")


def clean_text(text: Column, nbsp: str = " ", delete: tuple[str, ...] = ()) -> Column:
    """Markup away, line feeds and tabs deleted, carriage returns to blanks; NULL when empty."""
    return none_if(_clean(text, nbsp, delete))


def clean_all(items: Column, glue: str = " ", nbsp: str = " ", delete: tuple[str, ...] = ()) -> Column:
    """Clean every item and join what is left; NULL when nothing is."""
    cleaned = F.transform(items, lambda item: _clean(item, nbsp, delete))
    return none_if(F.array_join(F.filter(cleaned, lambda item: item != ""), glue))


def squeeze(text: Column) -> Column:
    """Runs of any blank to one blank, none at the ends. A single plain blank is no match, so most
    texts are only looked through."""
    other = rf"\t-\r{NBSP}\u3000"
    return F.trim(F.regexp_replace(text, f"(?: [ {other}]|[{other}])[ {other}]*", " "))


def drop_label(text: Column, *labels: str) -> Column:
    """Without the labels, wherever they stand, and without outer blanks."""
    return F.trim(replace_each(text, [(label, "") for label in labels]))


def paragraphs_with(paragraphs: Column, pattern: str) -> Column:
    return F.filter(paragraphs, lambda paragraph: paragraph.rlike(pattern))


def fee_around_dollar(paragraphs: Column) -> Column:
    """Text node with the first dollar sign of the first paragraph that has one and no full stop."""
    priced = F.filter(paragraphs, lambda p: p.contains("$") & ~p.contains("."))
    return none_if(F.regexp_extract(F.get(priced, F.lit(0)), r"^[^$]*?>([^<>$]*\$[^<>]*)<", 1))


def dollar_amount_text(text: Column) -> Column:
    """The first plain price, such as ``$60``."""
    return none_if(F.regexp_extract(text, r"[$]\d+", 0))


def fee_amount(fee: Column) -> Column:
    """Number of the first price in a fee text (after ``$`` or ``HKD``), NULL when it has none.

    Up to 36 digits before the point, the most a decimal holds.
    """
    number = F.regexp_extract(fee, r"(?:\$|\bHKD)\s*(\d[\d,]*(?:\.\d{1,2})?)", 1)
    return F.replace(number, F.lit(","), F.lit("")).try_cast("decimal(38,2)")


def organiser_of_title(title: Column) -> Column:
    """The part before `` @ ``, without a bracketed prefix; NULL when the title names none."""
    head = F.split(title, " @ ", 2)[0]
    end_of_prefix = F.instr(head, "] ")
    named = F.when(end_of_prefix > 0, F.substr(head, end_of_prefix + 2)).otherwise(head)
    return F.when(title.contains(" @ "), named)
