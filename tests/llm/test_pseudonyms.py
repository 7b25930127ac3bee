import calendar
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from opinara.llm import pseudonyms as p
from tests.llm.helpers import AWKWARD, documents

KEY = "k"
CARDS = ["4111111111111111", "4111 1111 1111 1111", "3782-822463-10005"]
VALID = [*CARDS, "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "192.168.0.1", "2024-02-29", "31/12/1999", "31.12.1999",
         "123-45-6789", "+1 (017) 555-7713", "(212) 555-1234", "jo.22@mail7.example.com", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"]
INVALID = ["4111111111111112", "DE89370400440532013001", "300.1.1.1", "2023-02-29", "666-45-6789", "1.2.3.4.5", "12345", "v1.2"]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed([int(c) for c in digits if c.isdigit()])):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def shape(text):
    return re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text)))


def moved(spark, texts, key=KEY):
    return [r.text for r in p.pseudonymise(documents(spark, texts), key, changed="n").orderBy("doc_id").collect()]


def keyed(kind, step, value):
    return hashlib.sha256(f"{KEY}|{kind}|{step}|{value}".encode()).hexdigest()


def string_feistel(text, kind):
    half = len(text) // 2
    sides = [text[:half], text[half:]]
    for step in range(p.ROUNDS):
        own, other = sides[step % 2], sides[1 - step % 2]
        stream = keyed(kind, step, f"{len(own)}|{other}")
        out = ""
        for k, c in enumerate(own):
            by = int(stream[(k % 16) * 4 : (k % 16) * 4 + 4], 16) + k // 16
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + by) % size)
                    break
            out += c
        sides[step % 2] = out
    return "".join(sides)


def test_values_keep_their_format_and_validity(spark):
    got = moved(spark, VALID)
    for before, after in zip(VALID, got, strict=True):
        assert after != before
        if before != "192.168.0.1" and not before.startswith("9233A8"):
            assert shape(after) == shape(before)
    assert all(luhn(x) for x in got[:3])
    assert re.sub(r"\D", "", got[0]) == re.sub(r"\D", "", got[1])
    assert re.fullmatch("[0-9A-F]{40}", got[-1])
    again = p.pseudonymise(documents(spark, got), KEY, changed="n")
    assert again.where("n = 0").count() == 0  # pseudonyms are valid values themselves
    assert moved(spark, INVALID) == INVALID


def test_against_a_plain_python_feistel(spark):
    got = moved(spark, ["(212) 555-1234", "jo.22@mail7.example.com", "4111111111111111"])
    assert re.sub(r"\D", "", got[0]) == string_feistel("2125551234", "phone")
    assert got[1] == string_feistel("jo.22@mail7.example", "email") + ".com"
    assert got[2][:-1] == string_feistel("411111111111111", "card")


def test_permutations_hit_every_value_once(spark):
    days = spark.range(73_049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = p.pseudonymise(days, KEY).agg(F.count_distinct("text"), F.min("text"), F.max("text")).first()
    assert tuple(out) == (73_049, "1900-01-01", "2099-12-31")
    short = spark.range(1000).select(F.format_string("(555) 000-0%03d", F.col("id")).alias("text"))
    assert p.pseudonymise(short, KEY).agg(F.count_distinct("text")).first()[0] == 1000


def test_slashed_dates_are_permuted_among_all_their_spellings(spark):
    day = F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int"))
    days = spark.range(73_049).select(F.explode(F.array(F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "dd/MM/yyyy"))).alias("text"))
    spellings = days.distinct()
    rows = spellings.select("text", F.col("text").alias("was"))
    out = p.pseudonymise(rows.repartition(8), KEY).join(spellings.withColumnRenamed("text", "known"), F.col("text") == F.col("known"), "left")
    got = out.agg(F.count("*"), F.count_distinct("text"), F.count("known"), F.count_if(F.col("text") == F.col("was"))).first()
    assert tuple(got)[:3] == (117_298,) * 3 and got[3] < 20
    assert moved(spark, ["30/02/2001", "13/13/2001", "00/01/2001"]) == ["30/02/2001", "13/13/2001", "00/01/2001"]


def plain_slashed(text):
    """The walk through the valid places, place by place."""
    months = [(y, m) for y in range(1900, 2100) for m in range(1, 13)]
    length = [calendar.monthrange(*x)[1] for x in months]
    days = [f"{m:02}/{d:02}/{y}" for (y, m), n in zip(months, length, strict=True) for d in range(1, n + 1)]
    late = [f"{d:02}/{m:02}/{y}" if d <= n else None for (y, m), n in zip(months, length, strict=True) for d in range(13, 32)]
    places = days + late + [None] * (p._PLACES[0] * p._PLACES[1] - len(days) - len(late))
    at = places.index(text)
    while True:
        sides = [at % p._PLACES[0], at // p._PLACES[0]]
        for step in range(p.ROUNDS):
            k = step % 2
            sides[k] = (sides[k] + int(keyed("slashed", step, sides[1 - k])[:15], 16)) % p._PLACES[k]
        at = sides[1] * p._PLACES[0] + sides[0]
        if places[at]:
            return places[at]


def test_slashed_dates_against_a_plain_walk(spark):
    texts = ["01/02/2003", "31/12/1999", "12/31/1999", "29/02/2000", "13/01/1900", "31/12/2099", "12/12/2012"]
    assert moved(spark, texts) == [plain_slashed(t) for t in texts]


def test_equal_values_link_and_texts_around_stay(spark):
    texts = [f"é {a}, x|{b} end" for a in VALID for b in VALID[:4]]
    got = moved(spark, texts)
    alone = dict(zip(VALID, moved(spark, VALID), strict=True))
    assert got == [f"é {alone[a]}, x|{alone[b]} end" for a in VALID for b in VALID[:4]]
    assert moved(spark, VALID[:1], "other") != moved(spark, VALID[:1])


def test_awkward_rows_columns_and_empty_tables(spark):
    long_ = "word " * 20_000 + "4111111111111111"
    docs = documents(spark, [*AWKWARD, long_, "a@b.example", "a@b.example"]).withColumn("_found", F.lit(1))
    out = p.pseudonymise(docs, KEY)
    assert out.columns == docs.columns and out.where("_found = 1").count() == docs.count()
    got = [r.text for r in out.orderBy("doc_id").collect()]
    assert got[: len(AWKWARD)] == AWKWARD
    assert got[-3].startswith("word word") and not got[-3].endswith("4111111111111111") and got[-1] == got[-2] != "a@b.example"
    assert p.pseudonymise(docs.where("false"), KEY).count() == 0
    with pytest.raises(ValueError, match="key"):
        p.pseudonymise(docs, "")
    plan = p.pseudonymise(docs, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
