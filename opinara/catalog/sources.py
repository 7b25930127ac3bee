"""File and table round trips on data written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions.text import strip
from opinara.operators import gold, quality, refine
from opinara.operators.windows import recent_keys, reconcile
from opinara.plans import daily
from opinara.schemas import (
    FLAT_SOURCE,
    JOINED_SOURCE,
    REVIEW_FIELDS,
    SILVER,
    TRAINING_CONTRACT,
    conform,
    schema_diff,
)
from opinara.session import scratch_path, stage
from opinara.sources import files, key_index, tables

LABEL_SQL = "CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END"


@query("a1_json_lines", f"""WITH {v.DOCUMENTS}
SELECT doc_id, text, lang, '' AS absent FROM d""")
def json_lines(spark, sf):
    """Every document as a JSON line between a blank and a broken one."""
    path = scratch_path(spark, "json")
    line = F.to_json(F.struct("doc_id", "text", "lang", "source"))
    lines = F.explode(F.array(F.lit("  "), line, F.concat(F.lit('{"doc_id": '), "doc_id", F.lit(', "text'))))
    v.documents(spark, sf).select(lines.alias("value")).write.text(path)
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("absent", T.StringType()),
    ])
    return files.read_json_records(spark, path, schema).withColumn("absent", F.coalesce("absent", F.lit("")))


@query("a2_flat_csv", f"""WITH {v.DOCUMENTS}
SELECT concat('author ', doc_id) AS "Author", 'a "quoted", title' AS "Title", nullif(text, '') AS "Review",
  CASE WHEN rating = 0 THEN NULL ELSE rating::INTEGER::VARCHAR END AS "Rating", raw_date AS "Dates", source AS "Restaurant",
  NULL::VARCHAR AS "Location", 'tripadvisor' AS _source, '2026-06-06T00:00:00Z' AS _ingested_at
FROM d WHERE contains(source, 'src1')""")
def flat_csv(spark, sf):
    """Multi-line quoted texts, NA ratings, an extra and an absent column."""
    path = scratch_path(spark, "csv")
    rating = F.when(F.col("rating") == 0, "NA").otherwise(F.col("rating").cast("int").cast("string"))
    v.documents(spark, sf).select(
        F.col("n_chars").alias("Extra"),
        F.concat(F.lit("author "), "doc_id").alias("Author"),
        F.lit('a "quoted", title').alias("Title"),
        F.col("text").alias("Review"),
        rating.alias("Rating"),
        F.col("raw_date").alias("Dates"),
        F.col("source").alias("Restaurant"),
    ).write.options(**files.CSV_WRITE).csv(path)
    return files.read_flat_csv(spark, path, "2026-06-06T00:00:00Z", keywords=["SRC1"])


@query("a2_split_csv", f"""WITH {v.DOCUMENTS}
SELECT concat('author ', doc_id) AS "Author", nullif(text, '') AS "Review", source AS "Title" FROM d""")
def split_csv(spark, sf):
    """A single file of every text, line breaks and all, read by as many tasks as it has splits."""
    path = scratch_path(spark, "csv")
    rows = v.documents(spark, sf).select(F.concat(F.lit("author "), "doc_id").alias("Author"), F.col("text").alias("Review"), F.col("source").alias("Title"))
    rows.coalesce(1).write.options(**{**files.CSV_WRITE, "maxRecordsPerFile": "0"}).csv(path)
    found = files.read_flat_csv(spark, path, "2026-06-06T00:00:00Z", in_scope_only=False, split=True)
    return found.select("Author", "Review", "Title")


def land(spark, sf, root, date, rows=None):
    """Flat Bronze of one ingestion date."""
    bronze = v.flat_bronze(spark, sf) if rows is None else rows
    files.write_bronze(refine.stamp(bronze, FLAT_SOURCE, f"{date}T00:00:00Z"), root, FLAT_SOURCE, "reviews", date)


@query("a5_bronze_partition_write", f"""WITH {v.DOCUMENTS}
SELECT '2026-06-06' AS dt, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars FROM d WHERE lang = 'en'
UNION ALL SELECT '2026-06-07', count(*), sum(length(text))::BIGINT FROM d""")
def bronze_partition_write(spark, sf):
    """A date landed twice holds the second landing; the other date is untouched."""
    root = scratch_path(spark, "bronze")
    everything = v.flat_bronze(spark, sf)
    land(spark, sf, root, "2026-06-06", everything)
    land(spark, sf, root, "2026-06-07", everything)
    land(spark, sf, root, "2026-06-06", everything.where("Restaurant = 'en'"))
    landed = spark.read.options(**files.CSV_READ).csv(files.bronze_path(root, FLAT_SOURCE, "reviews"))
    return landed.groupBy("dt").agg(
        F.count("*").alias("n_rows"), F.sum(F.length("Review")).alias("n_chars")
    )


@query("a6_bronze_read", f"""WITH {v.DOCUMENTS}
SELECT concat('author ', doc_id) AS "Author", _ingested_at FROM d, (VALUES ('2026-06-06T00:00:00Z'), ('legacy')) x(_ingested_at)""")
def bronze_read(spark, sf):
    """A landed date plus two that fall back to the undated file, which is read once."""
    root = scratch_path(spark, "bronze")
    land(spark, sf, root, "2026-06-06")
    legacy = refine.stamp(v.flat_bronze(spark, sf), FLAT_SOURCE, "legacy")
    legacy.write.options(**files.CSV_WRITE).csv(f"{files.bronze_path(root, FLAT_SOURCE, 'reviews')}.csv")
    dates = ["2026-06-06", "2026-06-08", "2026-06-09"]
    return files.read_bronze(spark, root, FLAT_SOURCE, "reviews", dates).select("Author", "_ingested_at")


def silver_docs(spark, sf):
    return conform(v.doc_silver(spark, sf).withColumn("_ingested_at", F.lit("2026-06-06T00:00:00Z")), SILVER)


@query("a7_silver_partition_read", f"""WITH {v.DOC_SILVER}
SELECT source_id, text, '' AS _ingested_at, date AS review_date FROM ds WHERE date >= '2023-01-01'""")
def silver_partition_read(spark, sf):
    """Partitions written without ``_ingested_at`` read with that column null."""
    root = scratch_path(spark, "silver")
    old = v.doc_silver(spark, sf).withColumn("review_date", F.col("date"))
    files.write_partitions(old, root)
    read = files.read_silver(spark, root).where("review_date >= '2023-01-01'")
    return read.select("source_id", "text", F.coalesce("_ingested_at", F.lit("")).alias("_ingested_at"), "review_date")


@query("a8_silver_partition_write", f"""WITH {v.DOC_SILVER}
SELECT * REPLACE (CASE WHEN restaurant <> 'en' THEN date END AS date), '2026-06-06T00:00:00Z' AS _ingested_at,
  CASE WHEN restaurant = 'en' THEN '__null__' ELSE date END AS review_date FROM ds""")
def silver_partition_write(spark, sf):
    root = scratch_path(spark, "silver")
    undated = F.when(F.col("restaurant") != "en", F.col("date"))
    files.write_silver(silver_docs(spark, sf).withColumn("date", undated), root)
    return files.read_silver(spark, root)


@query("a9_gold_store_write", f"""WITH {v.DOC_SILVER}
SELECT source_id AS review_id, text, {LABEL_SQL} AS label, date AS review_date FROM ds""")
def gold_store_write(spark, sf):
    silver_root, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    files.write_silver(silver_docs(spark, sf), silver_root)
    days = [r[0] for r in files.read_silver(spark, silver_root).select("review_date").distinct().collect()]
    daily.build_gold(spark, silver_root, gold_root, days)
    features, labels = files.read_gold(spark, gold_root)
    return features.join(labels.drop("review_date"), "review_id")


@query("a12_schema_diff", f"""WITH {v.DOC_SILVER}
SELECT 'text' AS "column", 'present' AS status, count(text) AS n_values FROM ds
UNION ALL SELECT 'label', 'missing', 0
""" + "".join(
    f"UNION ALL SELECT '{c}', 'extra', count({c}) FROM ds\n"
    for c in ("text_len", "source_id", "date")
) + "".join(
    f"UNION ALL SELECT '{c}', 'present', count({c}) FROM ds\n" for c in ("rating", "source", "restaurant", "location")
))
def schema_difference(spark, sf):
    return schema_diff(v.doc_silver(spark, sf), TRAINING_CONTRACT)


@query("a18_multi_file_read", f"""WITH {v.DOCUMENTS}
SELECT doc_id, text FROM d UNION ALL SELECT doc_id, text FROM d WHERE lang = 'fr'""")
def multi_file_read(spark, sf):
    path = scratch_path(spark, "extra")
    v.table(spark, sf, "documents").where("lang = 'fr'").write.parquet(path)
    return files.read_many(spark, [f"{sf}/documents.parquet", path], ["doc_id", "text"])


@query("a22_publish_partitions", f"""WITH {v.DOC_SILVER}, k AS (SELECT DISTINCT date FROM ds ORDER BY date DESC LIMIT 20),
  n AS (SELECT count(*) AS n FROM ds WHERE date IN (SELECT date FROM k))
SELECT 'reviews_silver' AS "table", n AS rows_written, n AS rows_stored FROM n
UNION ALL SELECT 'reviews_gold', n, n FROM n""")
def publish_partitions(spark, sf):
    """Publishing the same dates twice stores every review once."""
    silver_root, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    warehouse = scratch_path(spark, "warehouse")
    files.write_silver(silver_docs(spark, sf), silver_root)
    days = recent_keys(files.read_silver(spark, silver_root), 20)
    daily.build_gold(spark, silver_root, gold_root, days)
    tables.publish(spark, silver_root, gold_root, warehouse, days, v.NOW)
    written = tables.publish(spark, silver_root, gold_root, warehouse, days, v.NOW)
    stored = None
    for name in ("reviews_silver", "reviews_gold"):
        n = spark.read.parquet(f"{warehouse}/{name}").agg(
            F.lit(name).alias("table"), F.count("*").alias("rows_stored")
        )
        stored = n if stored is None else stored.unionByName(n)
    return written.join(stored, "table")


CLEANED = f"""SELECT {v.strip_sql("text")} AS text, label, rating, source, lang AS restaurant, source AS location FROM g"""
KEPT = "length(text) >= 5 AND regexp_matches(text, '[A-Za-zÀ-ɏ]')"


def training_input(spark, sf):
    return v.labelled(spark, sf).select(
        "text", "label", "rating", "source", F.col("lang").alias("restaurant"), F.col("source").alias("location")
    )


@query("a23_truncate_and_load", f"""WITH {v.LABELLED}, t AS ({CLEANED})
SELECT * REPLACE (least(greatest(rating, 1), 5) AS rating), (SELECT max(length(text)) > 10000 FROM t) AS refused FROM t
WHERE {KEPT}""")
def truncate_and_load(spark, sf):
    """The gate refuses texts beyond its limit; a gate without one lets every row, whole, replace a first load."""
    path = scratch_path(spark, "reviews")
    rating = F.least(F.greatest("rating", F.lit(1.0)), F.lit(5.0))
    rows = stage(training_input(spark, sf).withColumn("rating", rating), "training-input")
    try:
        tables.load_reviews_table(rows, path, lambda df: quality.verdict(quality.gold_gate(df)))
        refused = False
    except quality.GateFailed:
        refused = True
    for _ in range(2):
        tables.load_reviews_table(rows, path, lambda df: quality.verdict(quality.gold_gate(df, max_chars=None)))
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


@query("a23_load_what_passes", f"""WITH {v.LABELLED}, t AS ({CLEANED})
SELECT *, concat_ws(',', CASE WHEN rating NOT BETWEEN 1 AND 5 THEN 'between_1_5(rating)' END,
  CASE WHEN length(text) > 10000 THEN 'length_5_10000(text)' END) AS faults FROM t WHERE {KEPT}""")
def load_what_passes(spark, sf):
    """Rows that keep the rules are loaded, the others listed, whole, with the rules they break."""
    path, rejects = scratch_path(spark, "reviews"), scratch_path(spark, "rejects")
    for _ in range(2):
        tables.load_passing(training_input(spark, sf), path, rejects)
    rejected = spark.read.parquet(rejects).withColumn("faults", F.array_join("faults", ","))
    return spark.read.parquet(path).withColumn("faults", F.lit("")).unionByName(rejected)


@query("a27_training_csv", f"""WITH {v.LABELLED} SELECT text, label, review_date FROM f JOIN l USING (review_id)""")
def training_csv(spark, sf):
    frame = gold.training_frame(v.features(spark, sf), v.doc_labels(spark, sf))
    path = files.write_training_csv(frame, scratch_path(spark, "training"))
    return spark.read.options(**files.CSV_READ).csv(path)


# ---------- incremental jobs ----------

def joined_bronze(spark, sf):
    """Order lines as landed joined-source Bronze, one row per id."""
    one = refine.latest_per_key(
        v.reviews(spark, sf), ["review_id"], "_ingested_at", ["text", "business_id", "stars", "supp", "price"]
    )
    texts = one.withColumn("stars", F.col("stars").cast("string"))
    return conform(texts, REVIEW_FIELDS)


ONE_LINE = v.LINES + """, o AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY review_id
  ORDER BY _ingested_at DESC, text DESC, business_id DESC, stars DESC, supp DESC, price DESC) AS rn FROM r) WHERE rn = 1)"""
INGESTED = ONE_LINE + ", " + v.BUSINESSES + f""", flat AS (
  SELECT {v.strip_sql("text")} AS text, rating, lang, source, date FROM d WHERE rating BETWEEN 1 AND 5),
  fd AS (SELECT *, row_number() OVER (PARTITION BY lang, text, date ORDER BY rating DESC, source DESC) AS rn FROM flat WHERE text <> ''),
  u AS (SELECT text, stars AS rating, 'yelp' AS source, date FROM o JOIN b USING (business_id) WHERE stars BETWEEN 1 AND 5
    UNION ALL SELECT text, rating, 'tripadvisor', date FROM fd WHERE rn = 1),
  k AS (SELECT * FROM u WHERE date::DATE >= (SELECT max(date::DATE) FROM u AS own WHERE own.source = u.source) - INTERVAL 3 YEAR)"""


def raw_both(spark, sf):
    parts = v.businesses(spark, sf).where("_ingested_at = '2024-01-02'").drop("_ingested_at")
    return {
        (JOINED_SOURCE, "reviews"): joined_bronze(spark, sf), (JOINED_SOURCE, "business"): parts,
        (FLAT_SOURCE, "reviews"): v.flat_bronze(spark, sf),
    }


def land_both(spark, sf, root, date):
    daily.land(spark, date, root, raw_both(spark, sf))


SUMMARY = """SELECT source, date AS review_date, count(*) AS n_rows, sum(rating) AS total_rating, sum(length(text))::BIGINT AS n_chars
FROM u GROUP BY ALL"""


def summarise(silver):
    return silver.groupBy("source", "review_date").agg(
        F.count("*").alias("n_rows"), F.sum("rating").alias("total_rating"), F.sum("text_len").alias("n_chars")
    )


@query("s1_bronze_to_silver", f"WITH {v.DOCUMENTS}, {INGESTED} {SUMMARY.replace('FROM u', 'FROM k')}")
def bronze_to_silver(spark, sf):
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    land_both(spark, sf, bronze, "2026-06-06")
    daily.ingest_to_silver(spark, bronze, silver, ["2026-06-06"], years=3)
    return summarise(files.read_silver(spark, silver))


@query("s3_idempotent_rerun", f"WITH {v.DOCUMENTS}, {INGESTED} {SUMMARY}")
def idempotent_rerun(spark, sf):
    """The same ingestion date processed twice gives the table of once."""
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    land_both(spark, sf, bronze, "2026-06-06")
    for _ in range(2):
        daily.ingest_to_silver(spark, bronze, silver, ["2026-06-06"], years=None)
    return summarise(files.read_silver(spark, silver))


@query("s4_daily_run", f"""WITH {v.DOCUMENTS}, {INGESTED}
SELECT date AS review_date, count(*) AS n_rows, count(*) AS n_features, count(*) AS n_labels, count(*) AS n_published FROM k GROUP BY date
UNION ALL SELECT 'total', count(*), count(*), count(*), count(*) FROM k""")
def daily_run(spark, sf):
    """Both sources landed, and on to Gold and the warehouse for one ingestion date, three years.

    The gate refuses partitions with texts beyond its limit and nothing lies behind it; as
    the SQL counts all rows, the run is then released without it.
    """
    bronze, silver, gold_root, warehouse = (scratch_path(spark, n) for n in ("bronze", "silver", "gold", "warehouse"))
    run = lambda **more: daily.run_daily(spark, "2026-06-06", bronze, silver, gold_root, warehouse=warehouse, **more)
    refused = False
    try:
        summary = run(raw=raw_both(spark, sf))
    except quality.GateFailed:
        refused = True
    failing = quality.silver_gate_by_key(files.read_silver(spark, silver)).where(~F.col("success"))
    if refused == failing.isEmpty():
        raise RuntimeError("the daily run does not stop where the Silver gate fails")
    if refused:
        behind = [files.load_if_present(spark.read.parquet, p) for p in (f"{gold_root}/feature_store", f"{warehouse}/reviews_gold")]
        if any(df is not None for df in behind):
            raise RuntimeError("the daily run wrote behind a gate that refused")
        summary = run(check=False)
    stored = spark.read.parquet(f"{warehouse}/reviews_gold")
    published = stored.groupBy("review_date").agg(F.count("*").alias("n_published"))
    days = reconcile(*files.read_gold(spark, gold_root)).join(published, "review_date")
    counts = ["n_features", "n_labels", "n_published"]
    total = days.agg(F.lit("total").alias("review_date"), *[F.sum(c).alias(c) for c in counts])
    return summary.join(days.select("review_date", *counts).unionByName(total), "review_date")


# Sources whose texts are within the Silver gate's limits.
SHORT_DOCUMENTS = v.DOCUMENTS.replace("FROM documents)", f"FROM documents WHERE length({v.strip_sql('text')}) BETWEEN 1 AND 5000)")


@query("s4_gated_run", f"""WITH {SHORT_DOCUMENTS}, {INGESTED}
SELECT date AS review_date, count(*) AS n_rows, count(*) AS n_features, count(*) AS n_labels, count(*) AS n_published FROM k GROUP BY date
UNION ALL SELECT 'total', count(*), count(*), count(*), count(*) FROM k""")
def gated_run(spark, sf):
    """A daily run whose landed texts keep the gate: all the way through it to the warehouse."""
    bronze, silver, gold_root, warehouse = (scratch_path(spark, n) for n in ("bronze", "silver", "gold", "warehouse"))
    raw = raw_both(spark, sf)
    flat = raw[(FLAT_SOURCE, "reviews")]
    raw[(FLAT_SOURCE, "reviews")] = flat.where(F.length(strip(F.col("Review"))).between(1, 5000))
    summary = daily.run_daily(spark, "2026-06-06", bronze, silver, gold_root, warehouse=warehouse, raw=raw, check=True)
    published = spark.read.parquet(f"{warehouse}/reviews_gold").groupBy("review_date").agg(F.count("*").alias("n_published"))
    days = reconcile(*files.read_gold(spark, gold_root)).join(published, "review_date")
    counts = ["n_features", "n_labels", "n_published"]
    total = days.agg(F.lit("total").alias("review_date"), *[F.sum(c).alias(c) for c in counts])
    return summary.join(days.select("review_date", *counts).unionByName(total), "review_date")


@query("a22_publish_time_stamps", f"""WITH {v.EVENTS}
SELECT review_date AS day, count(*) AS n_rows, count(DISTINCT ts) AS n_stamps FROM e GROUP BY 1""")
def publish_time_stamps(spark, sf):
    """Rows dated to the second, published twice: stored once each, a directory per day."""
    path = scratch_path(spark, "warehouse")
    rows = v.events(spark, sf).select(
        "source", F.col("review_id").alias("source_id"), "text", F.length("text").alias("text_len"), "rating",
        v.stamp_text("ts").alias("date"), F.lit("2026-06-06").alias("_ingested_at"),
    )
    for _ in range(2):
        tables.merge_table(spark, path, tables.silver_table_rows(rows), ["source", "source_id"])
    stored = spark.read.parquet(path)
    return stored.groupBy("day").agg(F.count("*").alias("n_rows"), F.count_distinct("review_date").alias("n_stamps"))


@query("a19_moved_reviews", f"""WITH {v.EVENTS}, x AS (SELECT review_id, id % 10 = 0 AS moved, rating,
  strftime(review_date::DATE + CASE WHEN id % 10 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d') AS day FROM e)
SELECT day, count(*) AS n_rows, count(*) FILTER (moved) AS n_moved,
  sum(CASE WHEN moved THEN 0.5::DOUBLE ELSE rating END) AS total_rating, '2024-01-05' AS opened FROM x GROUP BY day""")
def moved_reviews(spark, sf):
    """A tenth of the stored reviews come again with a later date: each is stored once, on its new day.

    ``opened`` lists the days that a batch of one day's keys would open.
    """
    path, keys = scratch_path(spark, "warehouse"), ["source", "source_id"]
    rows = v.events(spark, sf).select(
        "id", "source", F.col("review_id").alias("source_id"), "text", F.length("text").alias("text_len"), "rating",
        F.col("review_date").alias("date"), F.lit("2026-06-06").alias("_ingested_at"),
    )
    later = F.date_format(F.date_add(F.col("date").cast("date"), 3), "yyyy-MM-dd")
    moved = rows.where("id % 10 = 0").withColumns({"date": later, "rating": F.lit(0.5), "_ingested_at": F.lit("2026-06-07")})
    for part in (rows, moved):
        tables.merge_table(spark, path, tables.silver_table_rows(part), keys)
    stored = spark.read.parquet(path)
    opened = key_index.days_holding(spark, path, stored.where("day = '2024-01-05'").select(*keys), keys)
    return stored.groupBy("day").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("rating") == 0.5).alias("n_moved"), F.sum("rating").alias("total_rating"),
        F.lit(",".join(sorted(opened))).alias("opened"),
    )


@query("a25_store_undated", f"""WITH {v.EVENTS}
SELECT text, label, source, CASE WHEN id % 3 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ingested_at FROM e""")
def store_undated(spark, sf):
    """A third of the reviews have no date; a second store and clearing days keep them."""
    path = scratch_path(spark, "reviews")
    when = F.when(F.col("id") % 3 != 0, F.col("ts"))
    rows = v.events(spark, sf).select("id", "text", "label", "source", when.alias("ingested_at"))
    for k in range(2):
        tables.store_reviews(spark, path, rows.where(F.col("id") % 2 == k).drop("id"), "2099-01-01 00:00:00", clear_days=k)
    return tables.read_reviews(spark, path).withColumn("ingested_at", F.coalesce(v.stamp_text("ingested_at"), F.lit("")))
