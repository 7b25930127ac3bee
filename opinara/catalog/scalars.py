"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions import dates, keys, labels, text
from opinara.functions.fixed import EMOJI_POLARITY, PUNCTUATION


@query("h1_spoken_date", f"""WITH {v.DOCUMENTS}
SELECT doc_id, date AS parsed, NULL::VARCHAR AS relative FROM d""")
def spoken_date(spark, sf):
    return v.documents(spark, sf).select(
        "doc_id",
        dates.spoken_date(F.concat(F.lit("  "), "raw_date", F.lit(" "))).alias("parsed"),
        dates.spoken_date(F.concat("n_chars", F.lit(" weeks ago"))).alias("relative"),
    )


@query("h2_event_date", f"""WITH {v.EVENTS}
SELECT id, strftime(ts, '%Y-%m-%d') AS event_date, NULL::VARCHAR AS bad FROM e""")
def event_date(spark, sf):
    return v.events(spark, sf).select(
        "id",
        dates.event_date(v.stamp_text("ts")).alias("event_date"),
        dates.event_date(F.col("label")).alias("bad"),
    )


@query("h2_date_spellings", f"""WITH {v.DOCUMENTS}
SELECT doc_id, date AS event_date, date AS review_date FROM d""")
def date_spellings(spark, sf):
    """The same days spelled eight ways, chosen by document."""
    day = F.col("date").cast("date")
    patterns = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "MM/dd/yyyy' 10:00:00'", "MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy", "yyyy.M.d"]
    raw = F.date_format(day, patterns[0])
    for k, pattern in enumerate(patterns[1:], 1):
        raw = F.when(F.col("doc_id") % len(patterns) == k, F.date_format(day, pattern)).otherwise(raw)
    spelled = v.documents(spark, sf).withColumn("spelled", raw)
    return spelled.select(
        "doc_id", dates.event_date(F.col("spelled")).alias("event_date"), dates.review_date_key(F.col("spelled")).alias("review_date")
    )


@query("h3_silver_timestamps", f"""WITH {v.DOCUMENTS}
SELECT doc_id, date || ' 00:00:00.000000' AS from_iso, date || ' 00:00:00.000000' AS from_spoken FROM d""")
def silver_timestamps(spark, sf):
    return v.documents(spark, sf).select(
        "doc_id",
        v.stamp_text(dates.silver_timestamp(F.col("date"))).alias("from_iso"),
        v.stamp_text(dates.silver_timestamp(F.col("raw_date"))).alias("from_spoken"),
    )


@query("h4_partition_keys", f"""WITH {v.DOCUMENTS}
SELECT CASE WHEN lang = 'en' THEN '__null__' ELSE date END AS review_date, count(*) AS n_rows FROM d GROUP BY 1""")
def partition_keys(spark, sf):
    raw = F.when(F.col("lang") != "en", F.col("raw_date"))
    return v.documents(spark, sf).groupBy(dates.review_date_key(raw).alias("review_date")).agg(
        F.count("*").alias("n_rows")
    )


@query("h5_content_key", f"""WITH {v.DOCUMENTS}
SELECT doc_id, sha256(concat(lang, '|', text, '|', CASE WHEN source = 'src1' THEN '' ELSE date END)) AS source_id FROM d""")
def content_key(spark, sf):
    date = F.when(F.col("source") != "src1", F.col("date"))
    return v.documents(spark, sf).select(
        "doc_id", keys.content_key(F.col("lang"), F.col("text"), date).alias("source_id")
    )


@query("h6_review_key", f"""WITH {v.EVENTS}
SELECT id, substr(sha256(concat('spike|', review_date, '|', text)), 1, 16) AS review_key FROM e""")
def review_key(spark, sf):
    return v.events(spark, sf).select(
        "id", keys.review_key(F.lit("spike"), F.col("review_date"), F.col("text")).alias("review_key")
    )


@query("h7_gold_review_date", f"""WITH {v.DOCUMENTS}
SELECT doc_id, CASE lang WHEN 'en' THEN date WHEN 'fr' THEN date WHEN 'de' THEN '2020-01-01' END AS review_date FROM d""")
def gold_review_date(spark, sf):
    lang = F.col("lang")
    raw = (
        F.when(lang == "en", F.concat("date", F.lit(" 10:11:12")))
        .when(lang == "fr", F.concat("date", F.lit("T00:00")))
        .when(lang == "de", F.col("raw_date"))
    )
    source = F.when(lang == "en", "yelp").otherwise("tripadvisor")
    key = F.when(lang == "es", "__null__").otherwise("2020-01-01")
    return v.documents(spark, sf).select("doc_id", dates.gold_review_date(raw, source, key).alias("review_date"))


@query("h8_string_functions", f"""WITH {v.DOCUMENTS}, {v.BUSINESSES}, t AS (
  SELECT doc_id, {v.strip_sql("text")} AS stripped, text, source FROM d)
SELECT doc_id, length(stripped) AS stripped_len, lower(stripped) AS low, contains(text, 'the') AS has_the,
  CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '…' ELSE text END AS snippet,
  upper(source[1]) || lower(source[2:]) AS title FROM t""")
def string_functions(spark, sf):
    stripped = text.strip(F.col("text"))
    return v.documents(spark, sf).select(
        "doc_id",
        F.length(stripped).cast("long").alias("stripped_len"),
        F.lower(stripped).alias("low"),
        F.col("text").contains("the").alias("has_the"),
        text.snippet(F.col("text")).alias("snippet"),
        F.initcap("source").alias("title"),
    )


@query("h8_city_state", f"""WITH {v.BUSINESSES}
SELECT business_id, city || ', ' || state AS location FROM b""")
def city_state(spark, sf):
    part = v.table(spark, sf, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("business_id"),
        text.city_state(F.col("p_brand"), F.col("p_type")).alias("location"),
    )


@query("h9_numeric_coercion", f"""WITH {v.DOCUMENTS}
SELECT doc_id, rating AS plain, CASE WHEN lang = 'en' THEN rating END AS mixed, NULL::DOUBLE AS suffixed,
  rating BETWEEN 1 AND 5 AS in_range FROM d""")
def numeric_coercion(spark, sf):
    shown = F.col("rating").cast("string")
    mixed = F.when(F.col("lang") == "en", shown).when(F.col("lang") == "fr", "garbage").otherwise("NaN")
    return v.documents(spark, sf).select(
        "doc_id",
        text.number(F.concat(F.lit(" "), shown)).alias("plain"),
        text.number(mixed).alias("mixed"),
        text.number(F.concat(shown, F.lit("d"))).alias("suffixed"),
        text.number(shown).between(1, 5).alias("in_range"),
    )


@query("h10_label_from_rating", f"""WITH {v.DOCUMENTS}
SELECT doc_id, CASE WHEN source = 'src1' THEN 'neutral' WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative'
  ELSE 'neutral' END AS label FROM d""")
def label_from_rating(spark, sf):
    rating = F.when(F.col("source") == "src1", F.lit(float("nan"))).otherwise(F.col("rating"))
    return v.documents(spark, sf).select("doc_id", labels.label_from_rating(rating).alias("label"))


def normalise_sql(expr: str) -> str:
    sql = f"regexp_replace(lower({expr}), 'https?://{v.SQL_NON_SPACE}+|www\\.{v.SQL_NON_SPACE}+', ' ', 'g')"
    sql = f"regexp_replace({sql}, '@{v.SQL_WORD}+', ' ', 'g')"
    for symbol, polarity in EMOJI_POLARITY.items():
        sql = f"replace({sql}, '{symbol}', ' {polarity} ')"
    sql = f"regexp_replace({sql}, '[{PUNCTUATION}]', ' ', 'g')"
    return v.strip_sql(f"regexp_replace({sql}, '{v.SQL_SPACE}+', ' ', 'g')")


@query("h11_normalise_text", f"""WITH {v.DOCUMENTS}
SELECT doc_id, {normalise_sql("concat('See https://x.io/a?b @me👍 ', text)")} AS clean_text FROM d""")
def normalise_text(spark, sf):
    noisy = F.concat(F.lit("See https://x.io/a?b @me👍 "), "text")
    return v.documents(spark, sf).select("doc_id", text.normalise(noisy).alias("clean_text"))


@query("h12_class_labels", f"""WITH {v.EVENTS}
SELECT id, CASE id % 5 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' ELSE (id % 5)::VARCHAR END AS label,
  label AS kept FROM e""")
def class_labels(spark, sf):
    return v.events(spark, sf).select(
        "id",
        labels.label_from_class(F.col("id") % 5).alias("label"),
        labels.label_from_class(F.col("label")).alias("kept"),
    )


@query("h13_threshold_label", f"""WITH {v.EVENTS}
SELECT id, {v.threshold_sql(0.46)} AS tuned,
  CASE WHEN p_negative >= p_neutral AND p_negative >= p_positive THEN 'negative'
       WHEN p_neutral >= p_positive THEN 'neutral' ELSE 'positive' END AS argmax FROM e""")
def threshold_label(spark, sf):
    return v.events(spark, sf).select(
        "id",
        labels.label_from_scores(v.event_scores()).alias("tuned"),
        labels.label_from_scores(v.event_scores(), 0).alias("argmax"),
    )


@query("h14_calendar", f"""WITH {v.EVENTS}
SELECT id, strftime(ts - INTERVAL 3 YEAR, '%Y-%m-%d %H:%M:%S.%f') AS back,
  strftime(ts + INTERVAL 10 DAY, '%Y-%m-%d') AS shifted,
  strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week FROM e""")
def calendar(spark, sf):
    ts = F.col("ts")
    return v.events(spark, sf).select(
        "id",
        v.stamp_text(dates.years_before(ts, 3)).alias("back"),
        v.day_text(F.date_add(ts, 10)).alias("shifted"),
        v.day_text(dates.period(ts, "D")).alias("day"),
        v.day_text(dates.period(ts, "W")).alias("week"),
    )


@query("h15_category_sets", f"""WITH {v.BUSINESSES}
SELECT business_id, len(string_split(categories, ', ')) AS n_parts,
  list_has_any(string_split(categories, ', '), ['ring', 'widget']) AS wanted FROM b""")
def category_sets(spark, sf):
    parts = text.comma_set(F.replace("p_name", F.lit(" "), F.lit(" , ")))
    return v.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("business_id"),
        F.size(parts).cast("long").alias("n_parts"),
        text.overlaps(parts, ["ring", "widget"]).alias("wanted"),
    )


@query("h16_rounding", f"""WITH {v.EVENTS}
SELECT id, round_even(value, 1) AS half_even, round(ln(value + 1.0::DOUBLE), 9) AS logged,
  round_even(100.0::DOUBLE * p_negative, 0) AS pct FROM e""")
def rounding(spark, sf):
    return v.events(spark, sf).select(
        "id",
        F.bround("value", 1).alias("half_even"),
        F.round(F.ln(F.col("value") + 1.0), 9).alias("logged"),
        F.bround(F.lit(100.0) * F.col("p_negative"), 0).alias("pct"),
    )


@query("h17_url_parts", f"""WITH {v.REPORTS}
SELECT report_url, 'monitoring' AS bucket, substr(report_url, 17) AS key FROM m""")
def url_parts(spark, sf):
    url = F.col("report_url")
    return v.reports(spark, sf).select(
        url, text.bucket_of_url(url).alias("bucket"), text.key_of_url(url).alias("key")
    )
