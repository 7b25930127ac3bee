"""Structured Streaming versions of the Silver merge, the timeline and the alert.

Every sink replaces the partitions a micro-batch computed, so a batch that is run again
after a failure leaves the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opinara.operators.analytics import ALERT_PERCENT, percent_of
from opinara.plans.daily import upsert_silver
from opinara.schemas import DERIVED_LABEL_SOURCE, NULL_KEY
from opinara.session import stage
from opinara.sources.files import read_partitions, write_partitions

WINDOWS = {"D": ("1 day", "0 days"), "W": ("7 days", "4 days")}


def read_files(
    spark: SparkSession, root: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(root)


def silver_upserts(stream: DataFrame, silver_root: str, checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch of refined rows into its event-date partitions."""
    def apply(batch: DataFrame, _: int) -> None:
        upsert_silver(batch.sparkSession, batch, silver_root)

    return _start(stream, apply, "append", checkpoint)


def timeline(stream: DataFrame, ts: str, freq: str = "D", lateness: str = "1 day") -> DataFrame:
    """Label shares per event-time day or week; days older than ``lateness`` are dropped
    from state."""
    size, offset = WINDOWS[freq]
    return (
        stream.where(F.col(ts).isNotNull() & F.col("label").isNotNull())
        .withWatermark(ts, lateness)
        .groupBy(F.window(ts, size, startTime=offset).alias("w"))
        .agg(
            F.count("*").alias("n_reviews"),
            percent_of("positive").alias("pct_positive"),
            percent_of("negative").alias("pct_negative"),
            percent_of("neutral").alias("pct_neutral"),
        )
        .withColumn("period", F.date_format("w.start", "yyyy-MM-dd"))
        .drop("w")
    )


def timeline_table(timeline_stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep one up-to-date row per period under ``root``."""
    def apply(batch: DataFrame, _: int) -> None:
        write_partitions(batch, root, "period")

    return _start(timeline_stream, apply, "update", checkpoint)


def spike_alerts(
    timeline_stream: DataFrame, root: str, checkpoint: str, threshold: float = ALERT_PERCENT
) -> StreamingQuery:
    """Per micro-batch, whether the newest period it touched reaches the threshold."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max_by(F.struct("period", "n_reviews", "pct_negative"), "period").alias("r"))
        alert = newest.where("r IS NOT NULL").select("r.*").withColumns({
            "pct_negative": F.bround("pct_negative", 1),
            "alert": F.bround("pct_negative", 1) >= threshold,
            "batch": F.lit(str(batch_id)),
        })
        write_partitions(alert, root, "batch")

    return _start(timeline_stream, apply, "update", checkpoint)


def dedup(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str = "1 day") -> DataFrame:
    """The first row of each key; repeats are dropped as long as its key is in state.

    A key stays in state until the watermark (the newest ``ts`` less ``lateness``) has
    passed its row by ``lateness``, so repeats that come within it are found and state does
    not grow with the stream; later ones pass and are left to the keyed merge behind.
    Rows without a time are all kept, for no watermark ever passes them.
    """
    timed = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))
    return timed.unionByName(stream.where(F.col(ts).isNull()))


def append_batches(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Land each micro-batch in a partition of its own, which a batch run again replaces."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        write_partitions(batch.withColumn("batch", F.lit(str(batch_id))), root, "batch")

    return _start(stream, apply, "append", checkpoint)


def dropped_duplicates(query: StreamingQuery) -> int:
    """Repeats that a finished run dropped, by its recent progress."""
    return sum(
        state["customMetrics"].get("numDroppedDuplicateRows", 0)
        for progress in query.recentProgress for state in progress["stateOperators"]
    )


CORRECTED = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("label_source", T.StringType()),
    T.StructField("corrected_at", T.TimestampType()),
    T.StructField("correction_id", T.LongType()),
    T.StructField("settled", T.BooleanType()),
    T.StructField("review_date", T.StringType()),
])


def corrected_labels(
    gold: DataFrame, corrections: DataFrame, horizon: str = "30 days", lateness: str = "1 day", early: str = "0 seconds"
) -> DataFrame:
    """Reviews as they arrive, each correction as it meets its review, and reviews past correction.

    ``gold`` holds review_id, review_date, label and reviewed_at; ``corrections`` holds
    review_id, corrected_label, corrected_at and id. A correction counts from ``early``
    before to ``horizon`` after its review. Either side waits for the other in state, in
    whatever order they come, until the watermark has passed the horizon; then a review
    that none has met comes out once more, as ``settled``. Each review may come out several
    times: ``corrected_table`` keeps the newest.
    """
    own = gold.select("review_id", "review_date", "label", "reviewed_at")
    derived = F.lit(DERIVED_LABEL_SOURCE)
    arrived = own.select(
        "review_id", "label", derived.alias("label_source"), F.lit(None).cast("timestamp").alias("corrected_at"),
        F.lit(None).cast("long").alias("correction_id"), F.lit(False).alias("settled"), "review_date",
    )
    reviews = own.withWatermark("reviewed_at", lateness)
    theirs = corrections.select(
        F.col("review_id").alias("_review_id"), "corrected_label", "corrected_at", F.col("id").cast("long").alias("correction_id")
    ).withWatermark("corrected_at", lateness)
    in_time = F.expr(
        f"corrected_at >= reviewed_at - INTERVAL {early} AND corrected_at <= reviewed_at + INTERVAL {horizon}"
    )
    met = reviews.join(theirs, (F.col("review_id") == F.col("_review_id")) & in_time, "left_outer")
    human = F.col("_review_id").isNotNull()
    decided = met.select(
        "review_id", F.when(human, F.col("corrected_label")).otherwise(F.col("label")).alias("label"),
        F.when(human, F.lit("human")).otherwise(derived).alias("label_source"), "corrected_at", "correction_id",
        (~human).alias("settled"), "review_date",
    )
    return arrived.unionByName(decided)


def corrected_table(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep, by event date, one row per review: its latest correction, else its own label.

    A batch rewrites the dates of its reviews; run again, it leaves the same rows.
    """
    newest = F.struct("corrected_at", "correction_id", "settled")  # nulls are least

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch.withColumn("review_date", F.coalesce("review_date", F.lit(NULL_KEY))), "corrected")
        # Distinct calendar days.
        days = [r[0] for r in rows.select("review_date").distinct().collect()]
        both = read_partitions(spark, root, CORRECTED, days).unionByName(rows)
        kept = both.groupBy("review_id", "review_date").agg(
            F.max_by(F.struct("label", "label_source", "corrected_at", "correction_id", "settled"), newest).alias("_row")
        )
        write_partitions(kept.select("review_id", "_row.*", "review_date"), root)

    return _start(stream, apply, "append", checkpoint)


def _start(stream: DataFrame, apply, mode: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )
