"""The driver's tables seen as reviews, businesses, texts and labelled events.

Each view is written twice, as a DataFrame and as SQL, and kept in step by the checks.
"""

from __future__ import annotations

import glob
import os
import zipfile

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.labels import PRODUCTION_TAU, STAGING_TAU

# Last six days of the events table are the "current" side, the rest the reference.
SPLIT_DAY = "2024-01-24"
NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# ---------- lineitem as reviews, part as businesses ----------

def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined-source Bronze: one review per order line, ids repeat."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("review_id"),
        F.col("l_partkey").cast("string").alias("business_id"),
        F.col("l_linenumber").cast("double").alias("stars"),
        F.concat(F.lit("Order "), "l_orderkey", F.lit(" returned "), "l_returnflag").alias("text"),
        day_text("l_shipdate").alias("date"),
        day_text("l_shipdate").alias("_ingested_at"),
        F.col("l_linestatus").alias("source"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_extendedprice").alias("price"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped rows straight from the order lines, two sources, ids repeat."""
    r = reviews(spark, sf_dir)
    return r.select(
        "text",
        F.length("text").alias("text_len"),
        F.col("stars").alias("rating"),
        "source",
        F.col("review_id").alias("source_id"),
        F.col("business_id").alias("restaurant"),
        F.col("supp").cast("string").alias("location"),
        "date",
        "_ingested_at",
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every business twice: an old record and the current one, which is ingested later."""
    part = table(spark, sf_dir, "part")
    now = part.select(
        F.col("p_partkey").cast("string").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("city"),
        F.col("p_type").alias("state"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("categories"),
        F.lit("2024-01-02").alias("_ingested_at"),
    )
    old = now.withColumns({"name": F.concat(F.lit("old "), "name"), "_ingested_at": F.lit("2024-01-01")})
    return old.unionByName(now)


LINES = """r AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS review_id, l_partkey::VARCHAR AS business_id,
    l_linenumber::DOUBLE AS stars, concat('Order ', l_orderkey, ' returned ', l_returnflag) AS text,
    strftime(l_shipdate, '%Y-%m-%d') AS date, strftime(l_shipdate, '%Y-%m-%d') AS _ingested_at,
    l_linestatus AS source, l_suppkey AS supp, l_extendedprice AS price
  FROM lineitem)"""
SILVER = LINES + """, s AS (
  SELECT text, length(text)::INTEGER AS text_len, stars AS rating, source, review_id AS source_id,
    business_id AS restaurant, supp::VARCHAR AS location, date, _ingested_at FROM r)"""
BUSINESSES = """b AS (
  SELECT p_partkey::VARCHAR AS business_id, p_name AS name, p_brand AS city, p_type AS state,
    replace(p_name, ' ', ', ') AS categories FROM part)"""


# ---------- events as a labelled stream ----------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    label = (
        F.when(kind == "error", "negative").when(kind.isin("purchase", "signup"), "positive").otherwise("neutral")
    )
    p = F.col("p_negative")
    return e.select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        day_text("ts").alias("review_date"),
        F.concat(F.lit("user "), "user_id").alias("text"),
        kind.alias("source"),
        label.alias("label"),
        (F.col("event_id") % 5 + 1).cast("double").alias("rating"),
        "value",
        ((F.col("event_id") * 7919 % 1000) / F.lit(1000.0)).alias("p_negative"),
    ).withColumn("p_neutral", (F.lit(1.0) - p) * ((F.col("id") * 31 % 100) / F.lit(100.0))).withColumn(
        "p_positive", F.lit(1.0) - p - F.col("p_neutral")
    )


def event_scores() -> dict[str, Column]:
    return {lb: F.col(f"p_{lb}") for lb in ("negative", "neutral", "positive")}


EVENTS = """e AS (
  SELECT *, 1.0::DOUBLE - p_negative - p_neutral AS p_positive FROM (
    SELECT *, (1.0::DOUBLE - p_negative) * ((id * 31 % 100)::DOUBLE / 100.0::DOUBLE) AS p_neutral FROM (
      SELECT event_id::VARCHAR AS review_id, event_id AS id, ts, strftime(ts, '%Y-%m-%d') AS review_date,
        concat('user ', user_id) AS text, event_type AS source,
        CASE WHEN event_type = 'error' THEN 'negative'
             WHEN event_type IN ('purchase', 'signup') THEN 'positive' ELSE 'neutral' END AS label,
        (event_id % 5 + 1)::DOUBLE AS rating, value,
        (event_id * 7919 % 1000)::DOUBLE / 1000.0::DOUBLE AS p_negative
      FROM events)))"""


def threshold_sql(tau: float) -> str:
    return (
        f"CASE WHEN p_negative >= {tau}::DOUBLE THEN 'negative' "
        "WHEN p_neutral >= p_positive THEN 'neutral' ELSE 'positive' END"
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both model stages said about every event, one row per stage."""
    from opinara.operators.model import shadow_score, stage_predictions

    e = events(spark, sf_dir)
    pairs = shadow_score(e, event_scores(), ["id", "text", F.col("ts").alias("predicted_at")])
    return stage_predictions(pairs, ["id", "text", "predicted_at"])


PREDICTIONS = EVENTS + f""", p AS (
  SELECT id, text, ts AS predicted_at, 'Production' AS stage, {threshold_sql(PRODUCTION_TAU)} AS predicted_label FROM e
  UNION ALL
  SELECT id, text, ts AS predicted_at, 'Staging' AS stage, {threshold_sql(STAGING_TAU)} AS predicted_label FROM e)"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring reports: one per event, several per run date."""
    return events(spark, sf_dir).select(
        F.col("review_date").alias("run_date"),
        F.when(F.col("source") == "view", "target_drift").otherwise("data_drift").alias("report_type"),
        F.concat(F.lit("s3://monitoring/"), "review_date", F.lit("/"), "review_id", F.lit(".html")).alias("report_url"),
        F.col("p_negative").alias("drift_score"),
        (F.col("p_negative") > 0.3).alias("blocked_promotion"),
        F.col("ts").alias("created_at"),
    )


REPORTS = EVENTS + """, m AS (
  SELECT review_date AS run_date, CASE WHEN source = 'view' THEN 'target_drift' ELSE 'data_drift' END AS report_type,
    concat('s3://monitoring/', review_date, '/', review_id, '.html') AS report_url, p_negative AS drift_score,
    p_negative > 0.3::DOUBLE AS blocked_promotion, ts AS created_at FROM e)"""


# ---------- documents as raw and labelled texts ----------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2021-01-01").cast("date"), (F.col("n_chars") % 1500).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "n_chars",
        "lang",
        "source",
        F.concat(F.lit("Reviewed "), F.date_format(day, "d MMMM yyyy")).alias("raw_date"),
        day_text(day).alias("date"),
        (F.col("doc_id") % 7).cast("double").alias("rating"),
    )


DOCUMENTS = """d AS (
  SELECT doc_id, text, n_chars, lang, source, rating, strftime(day, 'Reviewed %-d %B %Y') AS raw_date,
    strftime(day, '%Y-%m-%d') AS date FROM (
      SELECT *, (doc_id % 7)::DOUBLE AS rating, DATE '2021-01-01' + (n_chars % 1500)::INTEGER AS day FROM documents))"""


def flat_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the column names of the flat review CSV."""
    return documents(spark, sf_dir).select(
        F.concat(F.lit("author "), "doc_id").alias("Author"),
        F.concat(F.lit("title "), "source").alias("Title"),
        F.col("text").alias("Review"),
        F.col("rating").cast("int").cast("string").alias("Rating"),
        F.col("raw_date").alias("Dates"),
        F.col("lang").alias("Restaurant"),
        F.col("source").alias("Location"),
    )


def doc_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the Silver contract, values as they are (some break the gate)."""
    return documents(spark, sf_dir).select(
        "text", F.col("n_chars").cast("int").alias("text_len"), "rating",
        F.when(F.col("lang") == "en", "google").otherwise("tripadvisor").alias("source"),
        F.col("doc_id").cast("string").alias("source_id"), F.col("lang").alias("restaurant"),
        F.col("source").alias("location"), "date",
    )


DOC_SILVER = DOCUMENTS + """, ds AS (
  SELECT text, n_chars::INTEGER AS text_len, rating,
    CASE WHEN lang = 'en' THEN 'google' ELSE 'tripadvisor' END AS source, doc_id::VARCHAR AS source_id,
    lang AS restaurant, source AS location, date FROM d)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("date").alias("review_date"), "text"
    )


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("review_id"), label.alias("label"))


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label store with the event date of its document."""
    days = features(spark, sf_dir).select("review_id", "review_date")
    return doc_labels(spark, sf_dir).join(days, "review_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have a label."""
    return documents(spark, sf_dir).withColumn("review_id", F.col("doc_id").cast("string")).join(
        doc_labels(spark, sf_dir), "review_id"
    )


LABELLED = DOCUMENTS + """, f AS (
  SELECT doc_id::VARCHAR AS review_id, date AS review_date, text FROM d), l AS (
  SELECT doc_id::VARCHAR AS review_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
    ELSE 'neutral' END AS label FROM labels), ls AS (
  SELECT l.review_id, l.label, f.review_date FROM l JOIN f USING (review_id)), g AS (
  SELECT d.*, l.review_id, l.label FROM d JOIN l ON d.doc_id::VARCHAR = l.review_id)"""

# Whitespace and word characters as the functions define them.
SQL_SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SQL_NON_SPACE = "[^" + SQL_SPACE[1:]
SQL_WORD = r"[\p{L}\p{N}_]"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def list_sql(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def spark_stopwords() -> list[str]:
    """Spark's English stop words, also where the SQL is wanted before a session runs."""
    if SparkContext._active_spark_context is not None:
        return list(StopWordsRemover.loadDefaultStopWords("english"))
    jar = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))[0]
    with zipfile.ZipFile(jar) as z:
        return z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split("\n")
