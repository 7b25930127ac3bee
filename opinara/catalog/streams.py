"""Replay stream and the Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.catalog.reporting import LAST_DAY, PCTS, batch_pct
from opinara.plans.daily import keyed
from opinara.schemas import SILVER_PARTITIONED
from opinara.session import scratch_path
from opinara.sources import files
from opinara.streaming import jobs, replay

BRAND = "OurBrand"
REPLAY_ID = "substr(sha256(concat('spike|', review_date, '|', text)), 1, 16)"


def replay_source(spark, sf):
    return v.events(spark, sf).select(F.concat("text", F.lit(" #"), "id").alias("text"), "label", "review_date", "ts")


REPLAY = v.EVENTS + """, x AS (SELECT concat(text, ' #', id) AS text, label, review_date, ts FROM e)"""


@query("s5_replay_stream", f"""WITH {REPLAY}
SELECT {REPLAY_ID} AS review_id, review_date, text, label, 'replay' AS source, 'spike' AS scenario, '{BRAND}' AS brand FROM x""")
def replay_stream(spark, sf):
    return replay.replay_rows(replay_source(spark, sf), "spike", BRAND)


@query("s6_emit_by_date", f"""WITH {REPLAY}
SELECT review_date, count(*) AS n_rows, count(DISTINCT text) AS n_texts,
  (SELECT count(DISTINCT review_date) FROM x) AS n_partitions FROM x GROUP BY 1""")
def emit_by_date(spark, sf):
    root = scratch_path(spark, "replay")
    n = replay.emit(replay.replay_rows(replay_source(spark, sf), "spike", BRAND, ordered=False), root)
    landed = spark.read.parquet(root)
    return landed.groupBy("review_date").agg(
        F.count("*").alias("n_rows"), F.count_distinct("text").alias("n_texts")
    ).withColumn("n_partitions", F.lit(n).cast("long"))


@query("s7_streaming_silver", f"""WITH {v.EVENTS}
SELECT review_date, count(*) AS n_rows, count(*) FILTER (p_negative >= 0.5) AS n_edited,
  sum(CASE WHEN p_negative >= 0.5 THEN 5.0::DOUBLE ELSE rating END) AS total_rating FROM e GROUP BY 1""")
def streaming_silver(spark, sf):
    """Rows and later edits of half of them arrive as files; the newest of each stays."""
    source, silver = scratch_path(spark, "arrivals"), scratch_path(spark, "silver")
    e = v.events(spark, sf)
    rows = e.select(
        "text", "rating", F.lit("replay").alias("source"), F.col("review_id").alias("source_id"),
        F.lit("").alias("restaurant"), F.lit("").alias("location"), F.col("review_date").alias("date"),
        F.lit("1").alias("_ingested_at"), "p_negative",
    )
    edits = rows.where("p_negative >= 0.5").withColumns({
        "text": F.lit("edited"), "rating": F.lit(5.0), "_ingested_at": F.lit("2"),
    })
    for part in (edits, rows):
        keyed(part).write.mode("append").parquet(source)
    stream = jobs.read_files(spark, source, SILVER_PARTITIONED, files_per_batch=1)
    jobs.silver_upserts(stream, silver, scratch_path(spark, "checkpoint")).awaitTermination()
    return files.read_silver(spark, silver).groupBy("review_date").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("text") == "edited").alias("n_edited"),
        F.sum("rating").alias("total_rating"),
    )


def event_stream(spark, sf):
    source = scratch_path(spark, "events")
    rows = replay_source(spark, sf)
    files.write_partitions(rows, source)
    return jobs.read_files(spark, source, rows.schema)


@query("s8_streaming_timeline", f"""WITH {v.EVENTS}
SELECT review_date AS period, count(*) AS n_reviews, {PCTS} FROM e GROUP BY 1""")
def streaming_timeline(spark, sf):
    table = scratch_path(spark, "timeline")
    days = jobs.timeline(event_stream(spark, sf), "ts")
    jobs.timeline_table(days, table, scratch_path(spark, "checkpoint")).awaitTermination()
    out = spark.read.parquet(table)
    return out.withColumns({f"pct_{lb}": F.round(f"pct_{lb}", 9) for lb in ("positive", "negative", "neutral")})


@query("s9_streaming_alert", f"""WITH {v.EVENTS}, t AS (
  SELECT max(review_date) AS period, count(*) AS n_reviews, {batch_pct("negative")} FROM e WHERE ts >= {LAST_DAY})
SELECT *, pct_negative >= 25 AS alert FROM t""")
def streaming_alert(spark, sf):
    table = scratch_path(spark, "alerts")
    days = jobs.timeline(event_stream(spark, sf), "ts")
    jobs.spike_alerts(days, table, scratch_path(spark, "checkpoint")).awaitTermination()
    newest = spark.read.parquet(table).orderBy(F.desc("period"), F.desc("n_reviews")).limit(1)
    return newest.select("period", "n_reviews", "pct_negative", "alert")



@query("s10_streaming_dedup", f"""WITH {v.EVENTS}
SELECT review_date, count(*) AS n_rows, sum(rating) AS total_rating, (SELECT count(*) FROM e WHERE id % 3 = 0) AS n_dropped
FROM e GROUP BY 1""")
def streaming_dedup(spark, sf):
    """Two files of rows, and a third of all rows again in two more: each review lands once."""
    source, table = scratch_path(spark, "arrivals"), scratch_path(spark, "landed")
    rows = v.events(spark, sf).select("review_id", "id", "ts", "review_date", "rating", "source")
    again = rows.where("id % 3 = 0")
    for part in (rows.where("id % 2 = 0"), again.where("id % 2 = 0"), rows.where("id % 2 = 1"), again.where("id % 2 = 1")):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = jobs.read_files(spark, source, rows.schema, files_per_batch=1)
    run = jobs.append_batches(jobs.dedup(stream, ["review_id"], "ts", "60 days"), table, scratch_path(spark, "checkpoint"))
    run.awaitTermination()
    return spark.read.parquet(table).groupBy("review_date").agg(
        F.count("*").alias("n_rows"), F.sum("rating").alias("total_rating"),
        F.lit(jobs.dropped_duplicates(run)).cast("long").alias("n_dropped"),
    )


@query("s11_streaming_corrections", f"""WITH {v.LABELLED}, h AS (
  SELECT user_id::VARCHAR AS review_id, arg_max(CASE event_type WHEN 'error' THEN 'negative' WHEN 'view' THEN 'neutral'
    ELSE 'positive' END, (ts, event_id)) AS corrected FROM events GROUP BY 1)
SELECT l.review_id, coalesce(corrected, label) AS label,
  CASE WHEN corrected IS NULL THEN 'derived_from_rating' ELSE 'human' END AS label_source
FROM l LEFT JOIN h USING (review_id)""")
def streaming_corrections(spark, sf):
    """C7 as a stream: newest corrections arrive first, some before their reviews do."""
    gold_files, correction_files = scratch_path(spark, "reviews"), scratch_path(spark, "corrections")
    start = F.lit("2024-01-01").cast("timestamp")
    reviews = v.label_rows(spark, sf).withColumn("reviewed_at", start)
    kind = F.col("event_type")
    corrections = v.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("review_id"),
        F.when(kind == "error", "negative").when(kind == "view", "neutral").otherwise("positive").alias("corrected_label"),
        F.col("ts").cast("timestamp").alias("corrected_at"),
    )
    late = F.col("corrected_at") >= v.SPLIT_DAY
    for part in (corrections.where(late), corrections.where(~late)):
        part.coalesce(1).write.mode("append").parquet(correction_files)
    odd = F.pmod(F.hash("review_id"), F.lit(2)) == 1
    for part in (reviews.where(odd), reviews.where(~odd)):
        part.coalesce(1).write.mode("append").parquet(gold_files)
    table = scratch_path(spark, "corrected")
    rows = jobs.corrected_labels(
        jobs.read_files(spark, gold_files, reviews.schema, files_per_batch=1),
        jobs.read_files(spark, correction_files, corrections.schema, files_per_batch=1), "60 days", "60 days",
    )
    jobs.corrected_table(rows, table, scratch_path(spark, "checkpoint")).awaitTermination()
    return files.read_partitions(spark, table, jobs.CORRECTED).select("review_id", "label", "label_source")
