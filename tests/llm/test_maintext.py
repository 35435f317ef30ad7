"""Main text of pages with known articles."""

import pytest

from playbill.llm import maintext

LONG = "Some long sentence of the article that goes on for quite a while, with many words."
CASES = {
    "plain": (f"<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; me</footer></body></html>",
              f"Head\n{LONG}\nShort."),
    "unclosed": (f"<div class='ad'>Buy</div><article><p><b>{LONG}<br><p>Two &amp; a\n half&nbsp;.", f"{LONG}\nTwo & a half ."),
    "comments": (f"<main><p>{LONG}</p><div id='comments'><p>{LONG} Reader</p></div><section class=\"reader-comments\"><p>me too</p></section></main>", LONG),
    "divs": (f"<body><div class='sidebar'><p>{LONG}</p></div><div id='content'><h2>Title</h2><p>{LONG}</p><ul><li>one item</li><li>two</li></ul>"
             f"<div class='cookie-notice'>We use cookies</div><form><p>Your name <input></p></form></div><aside>More</aside></body>", f"Title\n{LONG}\none item\ntwo"),
    "scripts": (f"<article><p>{LONG}</p><script>var x = '<p>no</p>';</script><style>p{{}}</style><!-- no --><noscript>no</noscript><p>End</p></article>", f"{LONG}\nEnd"),
    "link list": (f"<div><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><p>{LONG} <a href=3>a link</a> after.</p></div>", f"{LONG} a link after."),
    "hidden": (f"<article><p>{LONG}</p><p style='display:none'>no</p><p hidden>no</p></article>", LONG),
    "cut": (f"<article><p>{LONG}</p><p>The end is cut &am", f"{LONG}\nThe end is cut &am"),
    "menu only": ("<nav><a href=x>Menu</a></nav><footer>f</footer>", ""),
    "text": ("no markup   at all", "no markup at all"),
    "references": (f"<article><p>{LONG} &eacute; &#233; &#xe9; &lt;b&gt;</p></article>", f"{LONG} é é é <b>"),
}


@pytest.mark.parametrize("name", list(CASES))
def test_case(name):
    html, expected = CASES[name]
    assert maintext.main_text(html) == expected


def test_rows(spark):
    pages = [(1, "u", CASES["plain"][0]), (1, "u", CASES["plain"][0]), (2, None, None), (None, "v", ""), (3, "w", f"<article><p>{LONG * 5000}</p></article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = maintext.extracted(df).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", 94), (1, "u", 94), (2, None, 0), (None, "v", 0), (3, "w", len(LONG) * 5000)]
    assert got[0].n_chars == len(CASES["plain"][1])
    assert maintext.extracted(df.limit(0)).count() == 0


def test_deep_nesting_takes_time_in_proportion():
    """40,000 unclosed elements and as many end tags that close nothing."""
    import time

    start = time.time()
    for page in ("<div>words of text " * 40_000 + "</x>" * 40_000, "<p><b><i>text " * 40_000, "<ul><li>text here" * 40_000):
        assert maintext.main_text(page)
    assert time.time() - start < 8
