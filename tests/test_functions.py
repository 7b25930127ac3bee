import hashlib
import re
import string

import pytest
from pyspark.sql import functions as F

from opinara.functions import dates, keys, labels, text
from opinara.functions.fixed import EMOJI_POLARITY
from tests.conftest import values


def one(frame, value, column):
    return frame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("Reviewed 6 February 2022", "2022-02-06"),
    ("reviewed 06 february 2022 ", "2022-02-06"),
    ("6 February 2022", "2022-02-06"),
    ("Reviewed 31 February 2022", None),
    ("Reviewed 3 weeks ago", None),
    ("yesterday", None),
    ("", None),
    (None, None),
])
def test_spoken_date(frame, raw, expected):
    assert one(frame, raw, dates.spoken_date) == expected


@pytest.mark.parametrize("raw, expected", [
    ("2021-06-01 10:11:12", "2021-06-01"), ("2021-06-01", "2021-06-01"), ("garbage", None), ("  ", None), (None, None),
])
def test_event_date(frame, raw, expected):
    assert one(frame, raw, dates.event_date) == expected


def test_silver_timestamp_falls_back_to_spoken_dates(frame):
    assert one(frame, "Reviewed 1 March 2020", lambda c: dates.iso(dates.silver_timestamp(c))) == "2020-03-01"


def test_partition_key(frame):
    assert one(frame, "nonsense", dates.review_date_key) == "__null__"
    assert one(frame, "2020-02-29", dates.review_date_key) == "2020-02-29"


def test_years_before_leap_day(frame):
    got = one(frame, "2020-02-29 12:00:00", lambda c: dates.years_before(c.cast("timestamp"), 3).cast("string"))
    assert got == "2017-02-28 12:00:00"


@pytest.mark.parametrize("raw, source, key, expected", [
    ("2021-01-01 09:00:00", "yelp", "2020-01-01", "2021-01-01"),
    ("rubbish", "yelp", "2020-01-01", "2020-01-01"),
    ("2021-01-01T00", "tripadvisor", "2020-01-01", "2021-01-01"),
    ("1 May 2021", "tripadvisor", "2020-01-01", "2020-01-01"),
    ("2021-01-01", "yelp", "__null__", None),
    (None, "yelp", "2020-01-01", "2020-01-01"),
])
def test_gold_review_date(frame, raw, source, key, expected):
    df = frame([(raw, source, key)], "r string, s string, k string")
    assert df.select(dates.gold_review_date(F.col("r"), F.col("s"), F.col("k"))).first()[0] == expected


def test_content_key_keeps_the_place_of_missing_parts(frame):
    df = frame([("r", "t", None)], "a string, b string, c string")
    got = df.select(keys.content_key(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert got == hashlib.sha256(b"r|t|").hexdigest()


def test_review_key(frame):
    df = frame([("2026-06-07", "tea")], "d string, t string")
    got = df.select(keys.review_key(F.lit("spike"), F.col("d"), F.col("t"))).first()[0]
    assert got == hashlib.sha256(b"spike|2026-06-07|tea").hexdigest()[:16]


@pytest.mark.parametrize("raw", ["  a b \n", " x ", "\x1cz\x1f", "", "plain"])
def test_strip_follows_unicode(frame, raw):
    assert one(frame, raw, text.strip) == raw.strip()


def test_not_blank(frame):
    rows = frame([("a",), ("  \n",), ("",), (None,)], "x string")
    assert [r[0] for r in rows.select(text.not_blank(F.col("x"))).collect()] == [True, False, False, False]


@pytest.mark.parametrize("raw, expected", [
    ("4", 4.0), (" 4.5 ", 4.5), ("1e1", 10.0), ("5d", None), ("NaN", None), ("garbage", None), ("", None), (None, None),
])
def test_number(frame, raw, expected):
    assert one(frame, raw, text.number) == expected


@pytest.mark.parametrize("name, expected", [
    ("Kopi Corner", True), ("The Steakhouse", False), ("Café Bleu", True), ("CAFÉ", True), ("Cafés", False),
    ("my ChaTime outlet", True), ("Old Town White", True), ("Tea House", True), ("Tea", False), (None, False),
])
def test_name_scope(frame, name, expected):
    assert one(frame, name, text.name_in_scope) is expected


def test_name_keywords_replace_the_terms(frame):
    assert one(frame, "The STEAKhouse", lambda c: text.name_in_scope(c, ["Steak"])) is True
    assert one(frame, "Kopi Corner", lambda c: text.name_in_scope(c, ["Steak"])) is False


def python_normalise(t: str) -> str:
    t = t.lower()
    t = re.sub(r"https?://\S+|www\.\S+", " ", t)
    t = re.sub(r"@\w+", " ", t)
    for symbol, polarity in EMOJI_POLARITY.items():
        t = t.replace(symbol, f" {polarity} ")
    t = "".join(" " if ch in string.punctuation else ch for ch in t)
    return " ".join(t.split())


@pytest.mark.parametrize("raw", [
    "LOVED it!!! 😍👍 see https://a.b/c?d=1, or www.x.io @you_2",
    "snake_case 'quotes' — dash   nbsp 100% ☹ ❤️ ❤",
    "Ünïcödé @größe Café.",
    "",
])
def test_normalise(frame, raw):
    assert one(frame, raw, text.normalise) == python_normalise(raw)


def test_words(frame):
    got = one(frame, "It's OK, don't go to a café 'quoted' x1y", text.words)
    assert got == re.findall(r"[A-Za-z][A-Za-z']{2,}", "it's ok, don't go to a café 'quoted' x1y")


@pytest.mark.parametrize("before, after", [
    ("Starbucks and star bucks", "B and B"), ("pretty interpret", "pretty interpret"), ("Pret a Manger", "B"),
    ("Costa Rica beans", "Costa Rica beans"), ("costa coffee", "B"), ("Dunkin' Donuts", "B"), ("MyMcDonald’s app", "B app"),
])
def test_rename_brands(frame, before, after):
    assert one(frame, before, lambda c: text.rename_brands(c, "B")) == after


def test_category_sets(frame):
    got = one(frame, " Coffee & Tea , Bars,, ", text.comma_set)
    assert got == ["Coffee & Tea", "Bars"]
    assert one(frame, "Gyms, Bars", lambda c: text.overlaps(text.comma_set(c), [])) is True
    assert one(frame, "Gyms, Bars", lambda c: text.overlaps(text.comma_set(c), ["Cafes"])) is False


def test_labels_from_ratings(frame):
    rows = frame([(5.0,), (4.0,), (3.0,), (2.0,), (1.0,), (None,), (float("nan"),)], "r double")
    got = [r[0] for r in rows.select(labels.label_from_rating(F.col("r"))).collect()]
    assert got == ["positive", "positive", "neutral", "negative", "negative", "neutral", "neutral"]


def test_labels_from_classes(frame):
    rows = frame([("0",), ("1",), ("2",), ("7",), ("negative",)], "x string")
    got = [r[0] for r in rows.select(labels.label_from_class(F.col("x"))).collect()]
    assert got == ["negative", "neutral", "positive", "7", "negative"]


def test_threshold(frame):
    df = frame([(0.46, 0.5, 0.04), (0.45, 0.1, 0.45), (0.45, 0.275, 0.275)], "n double, u double, p double")
    scores = {"negative": F.col("n"), "neutral": F.col("u"), "positive": F.col("p")}
    got = [tuple(r) for r in df.select(labels.label_from_scores(scores), labels.label_from_scores(scores, 0)).collect()]
    assert got == [("negative", "neutral"), ("positive", "negative"), ("neutral", "negative")]


def test_snippet_and_url(frame):
    assert one(frame, "a" * 201, text.snippet) == "a" * 200 + "…"
    assert one(frame, "a" * 200, text.snippet) == "a" * 200
    df = frame([("s3://monitoring/2026-06-06/x.html",)], "u string")
    assert values(df, text.bucket_of_url(F.col("u")), text.key_of_url(F.col("u"))) == [("monitoring", "2026-06-06/x.html")]


@pytest.mark.parametrize(("raw", "day"), [
    ("20240307", "2024-03-07"), ("2024/03/07", "2024-03-07"), ("2024.3.7", "2024-03-07"), ("03/07/2024 21:15:00", "2024-03-07"),
    ("27/03/2024", "2024-03-27"), ("Mar 7, 2024", "2024-03-07"), ("7 march 2024 9:05", "2024-03-07"), ("Sept 30, 2024", "2024-09-30"),
    ("2024-03-07T23:59:59Z", "2024-03-07"), ("2024-13-07", None), ("some day", None), ("", None),
])
def test_date_spellings(spark, raw, day):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(dates.event_date(F.col("raw"))).first()[0] == day
