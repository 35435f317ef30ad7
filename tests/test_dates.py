"""Golden date cases; today is 2020-06-18."""

import datetime

from pyspark.sql import functions as F

from playbill.functions import dates

AS_OF = datetime.date(2020, 6, 18)


def day(text):
    return datetime.date.fromisoformat(text) if text else None


RANGES = [
    ("17 Jun - 28 Jun, 2020", "open", "2020-06-17", "2020-06-28"),
    ("5 - 26 Aug, 2020", "open", "2020-08-05", "2020-08-26"),
    ("30 Dec, 2019 - 5 Jan, 2020", "open", "2019-12-30", "2020-01-05"),
    ("17 Jun, 2020", "open", "2020-06-17", None),
    ("5 Jun 2020 to 7 Jun 2020", "same", "2020-06-05", "2020-06-07"),
    ("5 June to 7 June 2020", "same", "2020-06-05", "2020-06-07"),
    ("5–26 August 2020", "same", "2020-08-05", "2020-08-26"),
    ("3 October 2020", "same", "2020-10-03", "2020-10-03"),
    ("From 2020-06-01", "open", "2020-06-01", None),
    ("Until 2020-07-01", "open", "2020-06-18", "2020-07-01"),
    ("2020-06-01 – 2020-07-01", "open", "2020-06-01", "2020-07-01"),
    ("18.06.2020 to 30.06.2020", "open", "2020-06-18", "2020-06-30"),
    ("18.06.2020", "open", "2020-06-18", None),
    ("2020.06.18 - 20", "same", "2020-06-18", "2020-06-20"),
    ("2020.06.18 - 07.02", "same", "2020-06-18", "2020-07-02"),
    ("2020.12.30 - 2021.01.02", "same", "2020-12-30", "2021-01-02"),
    ("2020.06.18", "same", "2020-06-18", "2020-06-18"),
    ("12 Jun 2020 (Fri)", "same", "2020-06-12", "2020-06-12"),
    ("Thu 18 Jun 2020", "same", "2020-06-18", "2020-06-18"),
    ("June 2020", "same", "2020-06-01", "2020-06-30"),
    ("January 2020 – February 2020", "same", "2020-01-01", "2020-02-29"),
    ("January – February 2020", "same", "2020-01-01", "2020-02-29"),
    ("13 Jun 2020 (Sat) – 14 Jun 2020 (Sun)", "same", "2020-06-13", "2020-06-14"),
    ("Now – June 2020", "same", "2020-06-18", "2020-06-30"),
    ("13 Jun 2020 (Sat) – onward", "open", "2020-06-13", None),
    ("13 Jun 2020 (Sat) – onward", "same", "2020-06-13", None),
    ("5 - 7 Jun 2020", "open", "2020-06-05", "2020-06-07"),
    ("5-7 Jun 2020", "open", "2020-06-05", "2020-06-07"),
    ("2020年 6月 5日 - 2020年 6月 7日", "open", "2020-06-05", "2020-06-07"),
    ("2020年 6月 5日", "open", "2020-06-05", None),
    ("8/6/2020 - 10/6/2020", "open", "2020-06-08", "2020-06-10"),
    ("5.6.2020", "open", "2020-06-05", None),
    ("8/6 (Mon)", "open", "2020-06-08", None),
    ("Sat, 12 October 2020 to\u00a014 October 2020", "same", "2020-10-12", "2020-10-14"),
    ("", "same", None, None),
    (None, "open", None, None),
    ("31 Feb 2020", "same", None, None),
    ("to be announced", "same", None, None),
]


def test_date_ranges(spark):
    rows = [(i, text, end) for i, (text, end, _, _) in enumerate(RANGES)]
    df = spark.createDataFrame(rows, "i int, text string, single_end string")
    out = dates.with_date_range(df, "text", AS_OF, F.col("single_end")).orderBy("i").collect()
    got = [(r.text, r.start_date, r.end_date) for r in out]
    assert got == [(t, day(s), day(e)) for t, _, s, e in RANGES]
    assert set(out[0].asDict()) == {"i", "text", "single_end", "start_date", "end_date"}


MENTIONS = [
    ("Open 5 - 7 June 2020.", "/en/a", "2020-06-05", "2020-06-07"),
    ("Open 5 - 7 June, 2020.", "/en/a", "2020-06-05", "2020-06-07"),
    ("On 3rd May", "/en/a", "2020-05-03", None),
    ("On 3 May", "/en/2019/a", "2020-05-03", None),
    ("On 3 May", "/en/2021/a", "2021-05-03", None),
    ("June 2020 and 4 Aug", "/en/a", "2020-06-01", "2020-08-04"),
    ("Maybe at the Market", "/en/a", None, None),
    ("5th-7th July 2021 or 1st Sep", "/en/a", "2021-07-05", "2021-09-01"),
    ("In year 1998 on 4 March", "/en/a", "2020-03-04", None),
    (None, None, None, None),
]


def test_mentioned_dates(spark):
    rows = [(i, text, url) for i, (text, url, _, _) in enumerate(MENTIONS)]
    df = spark.createDataFrame(rows, "i int, text string, url string")
    out = dates.with_mentioned_dates(df, "text", "url", AS_OF).orderBy("i").collect()
    expected = [(t, day(s), day(e)) for t, _, s, e in MENTIONS]
    expected[3] = ("On 3 May", day("2019-05-03"), None)
    assert [(r.text, r.start_date, r.end_date) for r in out] == expected


def test_screening_dates(spark):
    df = spark.createDataFrame([(["8/6 (Mon)", "Fri, 5/6", "hall"],), (["1/2/2019", "1/2/2019"],)], "t array<string>")
    out = [r.d for r in df.select(dates.screening_dates(F.col("t"), AS_OF).alias("d")).collect()]
    assert out == [[day("2020-06-05"), day("2020-06-08")], [day("2019-02-01")]]


def test_date_tokens_drop_times(spark):
    df = spark.createDataFrame([(["Thu 18 Jun 2020", "6:30pm", "Fri 19 Jun 2020"],)], "t array<string>")
    assert df.select(dates.date_tokens(F.col("t")).alias("d")).first().d == ["Thu 18 Jun 2020", "Fri 19 Jun 2020"]


def test_only_weekdays_are_no_words(spark):
    df = spark.createDataFrame([("Ted Sue Won Son Mat Tonday 5 June 2020 (Fri), Friday",)], "t string")
    assert df.select(dates.without_weekday(F.col("t")).alias("x")).first().x == "Ted Sue Won Son Mat Tonday 5 June 2020 ,"


def test_a_telephone_number_is_no_year(spark):
    rows = [("5 June, call 2834 5678 or 28345678", "http://x/20501234"), ("5 June", "http://x/2019/a"), ("5 June. Call 2034 5678", "http://x")]
    df = spark.createDataFrame(rows, "text string, url string")
    found = [r.start_date for r in dates.with_mentioned_dates(df, "text", "url", AS_OF).collect()]
    assert [d.year for d in found] == [AS_OF.year, 2019, AS_OF.year]
