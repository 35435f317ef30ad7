"""Golden cases of text cleaning, regions, tokens and fees."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from playbill.functions import html as H
from playbill.functions import text as X
from playbill.functions import tokens as K


def one(spark, column, **values):
    """Value of an expression over one row of string or array columns."""
    kinds = ", ".join(f"{n} {'array<string>' if isinstance(v, list) else 'string'}" for n, v in values.items())
    row = spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("x")).first()
    return row.x


def test_clean_text(spark):
    assert one(spark, X.clean_text(F.col("t")), t="<p>A&nbsp;<b>B</b>\r\n&amp; C</p>") == "A B & C"
    assert one(spark, X.clean_text(F.col("t"), "", ("#",)), t="<p>A&nbsp;#1\t</p>") == "A1"
    assert one(spark, X.clean_text(F.col("t")), t="<p></p>") is None
    assert one(spark, X.clean_text(F.col("t")), t=None) is None
    assert one(spark, X.clean_text(F.col("t")), t="&amp;lt;b&amp;gt;") == "&lt;b&gt;"


def test_clean_all_joins_with_a_blank(spark):
    assert one(spark, X.clean_all(F.col("t")), t=["<p>a</p>", "<p></p>", "<b>b</b>"]) == "a b"
    assert one(spark, X.clean_all(F.col("t")), t=[]) is None


TOKENS = ["  a", " b", "\n", "", "c"]


def test_clean_tokens(spark):
    assert one(spark, K.clean_tokens(F.col("t")), t=TOKENS) == ["a", "b", "c"]
    assert one(spark, K.clean_tokens(F.col("t"), K.BREAKS_FIRST), t=["\t x", "   "]) == ["x"]
    assert one(spark, K.clean_tokens(F.col("t"), K.HALVED_BLANKS), t=["a  b", "a    b", " "]) == ["a b", "ab"]
    assert one(spark, K.clean_tokens(F.col("t"), K.BLANKS_TWICE, True), t=[" a", "  ", "   "]) == ["a"]
    assert one(spark, K.clean_tokens(F.col("t"), K.BLANKS_TWICE, True), t=["x", "\n\n ", "  \n \n "]) == ["x", " "]


pieces = st.lists(st.sampled_from(["a", " ", "  ", "\n", " ", "&nbsp;", "&lt;", "&gt;", "&amp;", "> ", "<b>", "</b>", "<br>", "語"]), max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pieces, min_size=5, max_size=20))
def test_tokens_of_a_fragment_are_its_cleaned_text_nodes(spark, rows):
    df = spark.createDataFrame([("".join(row),) for row in rows], "t string")
    checks = []
    for steps, keep in ((K.BLANKS_FIRST, False), (K.BREAKS_FIRST, False), (K.HALVED_BLANKS, False), (K.BLANKS_TWICE, True)):
        nodes = F.transform(H.text_nodes(F.col("t")), X.unescape)
        checks.append(K.tokens_of(F.col("t"), steps, keep) == K.clean_tokens(nodes, steps, keep))
    wrong = df.where(~F.array_contains(F.array(*checks), False) == F.lit(False))
    assert wrong.count() == 0


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab <>/\n\t\r 語", max_size=30), min_size=1, max_size=20))
def test_clean_text_is_idempotent(spark, rows):
    df = spark.createDataFrame([(row,) for row in rows], "t string")
    once = X.clean_text(F.col("t"))
    assert df.where(~X.clean_text(once).eqNullSafe(once)).count() == 0


def test_labels(spark):
    tokens = ["Date", "5 Jun", "VENUE", "Hall"]
    value = K.after_label(F.col("t"), K.lower_tokens(F.col("t")), "venue")
    assert one(spark, value, t=tokens) == "Hall"
    absent = K.after_label(F.col("t"), K.lower_tokens(F.col("t")), "fee")
    assert one(spark, absent, t=tokens) is None
    assert one(spark, value, t=["venue"]) is None
    later = K.after_label(F.col("t"), K.lower_tokens(F.col("t")), "date", "venue")
    assert one(spark, later, t=tokens) == "Hall"
    first = K.after_label(F.col("t"), K.lower_tokens(F.col("t")), "date")
    assert one(spark, first, t=["date", "1", "date", "2"]) == "1"


def test_contained_label_takes_the_last_hit(spark):
    value = K.after_contained_label(F.col("t"), "Venue")
    assert one(spark, value, t=["Venue", "A", "Venue", "B"]) == "B"
    assert one(spark, value, t=["venue", "A"]) is None
    assert one(spark, value, t=["A", "Venue"]) is None
    assert one(spark, value, t=[]) is None


def test_calendar_header(spark):
    name, kind = K.calendar_header(F.col("t"), K.lower_tokens(F.col("t")), "back to monthly calendar", "date")
    both = F.array(name, kind)
    assert one(spark, both, t=["back to monthly calendar", "Expo", "DATE"]) == ["Expo", None]
    assert one(spark, both, t=["back to monthly calendar", "Talk", "Expo", "DATE"]) == ["Expo", "Talk"]
    assert one(spark, both, t=["Talk", "Expo", "DATE"]) == [None, None]


def test_take_until(spark):
    take = K.take_until(F.col("t"), "Know more about ")
    assert one(spark, take, t=["a", "b", "Know more about ", "c"]) == "a\nb"
    assert one(spark, take, t=["a", "b"]) == "a\nb"
    assert one(spark, take, t=["Know more about ", "b"]) == "Know more about \nb"
    assert one(spark, take, t=[]) is None


def test_fees(spark):
    assert one(spark, K.first_price_token(F.col("t")), t=["x $5.50", "$10"]) is None
    assert one(spark, K.first_price_token(F.col("t")), t=["x", "$10"]) == "$10"
    assert one(spark, K.first_word_token(F.col("t")), t=[" — ", "票價：$60"]) == "票價：$60"
    assert one(spark, X.fee_around_dollar(F.col("t")), t=["<p>a.$1</p>", "<p><b>Cost $100 each</b></p>"]) == "Cost $100 each"
    assert one(spark, X.dollar_amount_text(F.col("t")), t="Fee: $60 / $30") == "$60"
    assert str(one(spark, X.fee_amount(F.col("t")), t="HK$1,250.50 up")) == "1250.50"
    assert one(spark, X.fee_amount(F.col("t")), t="free") is None


def test_organiser_of_title(spark):
    assert one(spark, X.organiser_of_title(F.col("t")), t="[Online] HKU @ Talk") == "HKU"
    assert one(spark, X.organiser_of_title(F.col("t")), t="HKU @ Talk @ Noon") == "HKU"
    assert one(spark, X.organiser_of_title(F.col("t")), t="Talk") is None


def test_place_and_fee(spark):
    both = F.array(*K.place_and_fee(F.col("t")))
    assert one(spark, both, t=["Free entry"]) == [None, "Free entry"]
    assert one(spark, both, t=["Hall", "$5"]) == ["Hall", "$5"]
    assert one(spark, both, t=["Hall"]) == ["Hall", None]
    assert one(spark, both, t=["a", "b", "c"]) == [None, None]
    assert one(spark, both, t=[]) == [None, None]


def test_venue_sentence(spark):
    found = K.venue_sentence(F.col("t"), "venue", "Venue")
    assert one(spark, found, t=["Hello!", "Come in. Venue: Hall 3! Soon"]) == " Venue: Hall 3"
    assert one(spark, found, t=["Hello"]) is None


def test_element_bodies(spark):
    page = '<div class="a">1<div>2</div>3</div><p>x</p><DIV class="a"><div><div>4</div></div></DIV><div class="a">open'
    bodies = H.element_bodies(F.col("t"), r'<(?i:div)[^>]*\bclass="a"[^>]*>')
    assert one(spark, bodies, t=page) == ["1<div>2</div>3", "<div><div>4</div></div>", "open"]
    assert one(spark, bodies, t="<p>none</p>") == []
    assert one(spark, bodies, t='<div class="a"></div>') == [""]


def test_paragraphs_end_where_the_next_begins(spark):
    page = "<p>a<b>b</b></p><P class='x'>c<br><p>d<pre>e</pre>"
    assert one(spark, H.paragraphs(F.col("t")), t=page) == ["a<b>b</b>", "c<br>", "d<pre>e</pre>"]


def test_large_pages_without_closing_tags(spark):
    """No pattern may recurse or scan the rest of the page once per element."""
    from playbill.plans import rules as R, venues
    from playbill.plans.rendering import AS_OF

    filler = "<div><p>word <b>" * 20000
    for source in venues.EXTRACT:
        row = [(1, source, kind, lang, "http://x.example/", filler) for kind in ("detail", "list", "fee") for lang in ("en", "zh")]
        df = spark.createDataFrame(row, "page_id long, source string, page_kind string, lang string, url string, html string")
        pages = df.withColumn("fetched_at", F.lit("2020-01-01").cast("timestamp"))
        assert len(venues.page_halves(pages, AS_OF, [source]).collect()) <= 4
    assert R.VENUES.keys() == venues.EXTRACT.keys()


def test_links_and_attributes(spark):
    page = '<a class="x" href="/a">A</a><a data-href="/no">B</a><link href="/no"><a href="/b">'
    assert one(spark, H.link_targets(F.col("t")), t=page) == ["/a", "/b"]
    meta = '<meta content="first" name="description"><META property="og:title" content="Title">'
    assert one(spark, H.meta_content(F.col("t"), "property", "og:title"), t=meta) == "Title"
    assert one(spark, H.meta_content(F.col("t"), "name", "description"), t=meta) == "first"
    hidden = '<SCRIPT>var t="</p>";</SCRIPT>a<style>b</style>c<!-- d -->e'
    assert one(spark, H.drop_invisible(F.col("t")), t=hidden) == "ace"
    terms = "<dl><dt> Venue </dt><dd>\nHall</dd></dl>"
    assert one(spark, H.definition(F.col("t"), "Venue"), t=terms) == "\nHall"


def test_count_of(spark):
    assert one(spark, K.count_of(F.col("t"), "to").cast("int"), t="to October to") == 3


def test_element_inside_one_of_its_own_kind(spark):
    page = "x<div class=\"c\">a<div class=\"c\">b</div>c</div>z<DIV class='c'>d<div>e</div>f</DIV>"
    assert one(spark, H.element_bodies(F.col("t"), '<div class="c"[^>]*>'), t=page) == ['a<div class="c">b</div>c', "b", "d<div>e</div>f"]


def test_fee_amount_of_any_length(spark):
    assert str(one(spark, X.fee_amount(F.col("t")), t="$123,456,789.00")) == "123456789.00"
    assert str(one(spark, X.fee_amount(F.col("t")), t="HKD 120")) == "120.00"


def test_references(spark):
    text = "A&ndash;B &#8211; &#x2013; &copy 2020 &#128; &#99999999; &amp;lt; &nosuch; &lt;"
    assert one(spark, X.unescape(X.decode_references(F.col("t"))), t=text) == "A–B – – © 2020 € � &lt; &nosuch; <"


def test_attributes_as_pages_have_them(spark):
    page = "<A HREF='/x'> <a href='/y'> <a href=\"/z?a=1&amp;b=2\"> <a class=b href=/q>x</a>"
    assert one(spark, H.link_targets(F.col("t")), t=page) == ["/x", "/y", "/z?a=1&b=2", "/q"]
    meta = "<META CONTENT='it is' name=description>"
    assert one(spark, H.meta_content(F.col("t"), "name", "description"), t=meta) == "it is"
