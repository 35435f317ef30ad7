"""Main text of web pages by text-to-tag ratio.

A page is read as a stream of the standard library's parser events and cut into lines, one for each
block of text. The ratio of text (outside links) to tags of each line is smoothed with a Gaussian
kernel; lines above a threshold (the deviation of the smoothed ratios) form the content clusters.
They locate the content region, the element that holds them; what lies in it and is not marked as
menu, header, footer, sidebar, notice, advert, form or comments is the article.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split())
REGIONS = set("html body main article section div td center table tbody tr".split())
SKIPPED = set("head script style noscript template nav header footer aside form menu dialog button select textarea svg canvas iframe object audio video map math".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
MARKS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar sidebar aside header masthead footer comment comments disqus respond reply replies "
    "share sharing social related recommended newsletter subscribe subscription signup login search widget widgets skip".split()
)
NOT_MARKS = ("has-", "no-", "with-", "without-", "is-")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# elements that an implied end does not leave
BARRIERS = {"p": REGIONS | SKIPPED | {"blockquote", "ul", "ol", "dl", "li", "dd", "figure"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
RESTART = {"nav", "header", "form", "menu"}  # an article or main inside one of these was left unclosed or wraps the page
KERNEL = [math.exp(-(i**2) / 2) for i in range(-2, 3)]


def marked(tag: str, attrs: dict[str, str | None]) -> bool:
    """Whether an element says of itself that it is not content."""
    if tag in SKIPPED:
        return True
    if tag in ("html", "body", "main", "article") and not {"comment", "comments"} & set((attrs.get("class") or "").lower().split()):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or (attrs.get("role") or "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or ""):
        return True
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
        if name.startswith(NOT_MARKS):
            continue
        parts = re.split(r"[-_]+", name)
        if name in MARKS or parts[0] in MARKS or parts[-1] in MARKS:
            return True
    return False


class Open(NamedTuple):
    """An open element, with what its lines inherit: one look at the innermost element tells all, so
    that time and memory do not grow with the depth."""

    tag: str
    off: bool  # it or an element around it is not content
    region: int  # the innermost region, by number
    items: int  # the innermost list
    link: bool  # inside a link


PAGE = Open("", False, 0, 0, False)


class Lines(HTMLParser):
    """Collects the lines of a page: text, tags, text outside links, the region around it, skipped or
    not, and the list it is an item of."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Open] = []
        self.named: Counter[str] = Counter()  # how many elements of a name are open
        self.lines: list[tuple[str, int, int, int, bool, int]] = []
        # regions and lists by number: their names, and the region around a region
        self.kinds, self.around = [""], [0]
        self.text: list[str] = []
        self.tags = self.plain = 0

    def inner(self) -> Open:
        return self.stack[-1] if self.stack else PAGE

    def push(self, tag: str, off: bool) -> None:
        before = self.inner()
        region, items = before.region, before.items
        if tag in REGIONS or tag in ("ul", "ol"):
            self.kinds.append(tag)
            self.around.append(region)
            number = len(self.kinds) - 1
            region, items = (number, items) if tag in REGIONS else (region, number)
        self.stack.append(Open(tag, off or before.off, region, items, tag == "a" or before.link))
        self.named[tag] += 1

    def cut(self, place: int) -> None:
        """Close all elements from a place on."""
        for element in self.stack[place:]:
            self.named[element.tag] -= 1
        del self.stack[place:]

    def close_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            here = self.inner()
            self.lines.append((text, self.tags, self.plain, here.region, here.off, here.items))
            self.tags = 0
        self.text, self.plain = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            elif tag not in VOID:
                self.push(tag, marked(tag, dict(attrs)))
            return
        self.close_line()
        if tag in VOID:
            return
        if tag in ("article", "main"):
            while any(self.named[name] for name in RESTART):
                self.cut(len(self.stack) - 1)
        barriers = BARRIERS.get(tag, BARRIERS["p"])
        closes = CLOSES.get(tag, {"p"})
        if any(self.named[name] for name in closes):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag in closes:
                    self.cut(i)
                    break
                if self.stack[i].tag in barriers:
                    break
        self.push(tag, marked(tag, dict(attrs)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "iframe", "script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.close_line()
        if not self.named[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                self.cut(i)
                return
            if tag in INLINE and self.stack[i].tag not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if not self.inner().link:
            self.plain += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; the ends are weighed with what there is."""
    return np.convolve(ratios, KERNEL, "same") / np.convolve(np.ones(len(ratios)), KERNEL, "same") if len(ratios) >= len(KERNEL) else ratios


def main_text(html: str | None) -> str:
    """The article of a page; '' for NULL, an empty page and one without content."""
    reader = Lines()
    reader.feed(html or "")
    reader.close()
    reader.close_line()
    lines = reader.lines
    if not lines:
        return ""
    in_lists: dict[int, list[bool]] = {}
    for _, _, plain, _, _, items in lines:
        in_lists.setdefault(items, []).append(plain > 0)
    menus = {n for n, plain in in_lists.items() if n and len(plain) > 1 and not any(plain)}  # lists of links only
    off = [skipped or items in menus for _, _, _, _, skipped, items in lines]
    ratios = np.array([0.0 if skip else plain / max(1, tags) for (_, tags, plain, _, _, _), skip in zip(lines, off, strict=True)])
    smooth = smoothed(ratios)
    threshold = min(float(smooth.std()), float(smooth.max()))
    weight = [0] * len(reader.kinds)
    total = 0
    for (text, _, _, region, _, _), skip, value in zip(lines, off, smooth, strict=True):
        if not skip and value >= threshold:
            total += len(text)
            weight[region] += len(text)
    if not total:
        return ""
    for n in range(len(weight) - 1, 0, -1):  # what is in a region is in those around it
        if reader.kinds[n] in REGIONS and reader.around[n]:
            weight[reader.around[n]] += weight[n]
    # the innermost region with nearly all content, or the outermost article or main with most of it
    named = [n for n, w in enumerate(weight) if reader.kinds[n] in ("article", "main") and w > 0.5 * total]
    chosen = min(named) if named else max((n for n, w in enumerate(weight) if n and w >= 0.85 * total), default=0)
    inside = [not chosen] * len(weight)
    for n in range(1, len(weight)):
        inside[n] = n == chosen or inside[reader.around[n]]
    return "\n".join(text for (text, _, _, region, _, _), skip in zip(lines, off, strict=True) if not skip and inside[region])


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages, from the whole page.

    Character references are decoded, white space in a block becomes one blank, blocks are joined by
    line feeds in page order. Broken and cut pages are read as far as they go. NULL and empty pages
    give an empty text; repeated rows stay; an empty table gives no rows.
    """
    kinds = pages.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {kinds[id_column].dataType.simpleString()}, url {kinds[url_column].dataType.simpleString()}, text string, n_chars long"
    return pages.select(F.col(id_column), F.col(url_column), F.col(html_column)).mapInArrow(rows, schema)
