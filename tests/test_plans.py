"""The physical plans that matter at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from opinara import catalog
from opinara.catalog import views
from opinara.operators import gold, refine, windows
from opinara.plans import daily
from opinara.sources import files

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def silver(spark, tmp_path):
    root = str(tmp_path / "silver")
    rows = views.silver(spark, SF_DIR).withColumn("date", F.concat(F.substring("date", 1, 7), F.lit("-01")))
    files.write_silver(rows, root)
    return root


def test_dedup_limits_copies_before_the_shuffle(spark):
    text = plan(refine.dedup_silver(views.silver(spark, SF_DIR)))
    assert text.count("WindowGroupLimit") >= 2


def test_recency_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    views.reviews(spark, SF_DIR).withColumn("at", F.col("date").cast("timestamp")).write.parquet(path)
    text = plan(refine.recent_years(spark.read.parquet(path), 3, date="at").select("review_id"))
    assert "GreaterThanOrEqual(at" in text and "Exchange" not in text


def test_recent_partitions_prune_directories(spark, silver):
    text = plan(windows.recent_partitions(files.read_silver(spark, silver), 2).select("text"))
    assert "review_date" in text.split("PartitionFilters")[1].splitlines()[0]
    assert "ReadSchema: struct<text:string>" in text


def test_replay_window_prunes_directories(spark, silver):
    text = plan(windows.replay_window(files.read_silver(spark, silver), "2030-01-01", 3))
    assert ">= " in text.split("PartitionFilters")[1].splitlines()[0]


def test_timeline_reads_its_columns_and_aggregates_before_the_shuffle(spark):
    text = plan(catalog.queries()["d1_timeline_day"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp,event_type:string>" in text
    assert "partial_count" in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", [
    "b5_refine_joined", "c1_business_lookup", "c7_human_corrections", "d8_shadow_agreement", "g1_union_refined",
    "k8_promotion_gate", "a19_upsert_silver", "a15_gold_window", "e11_train_val_test_oot", "m8_document_frequencies",
])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    for bad in ("NestedLoop", "Cartesian", "EvalPython", "MapInPandas"):
        assert bad not in text


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """Two thirds of the rows share a date; the write splits them by size."""
    root = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        rows = spark.range(60_000).select(
            F.sha2(F.col("id").cast("string"), 512).alias("text"), F.col("id").cast("string").alias("source_id"),
            F.when(F.col("id") % 3 > 0, "2021-01-01").otherwise("2021-01-02").alias("review_date"),
        )
        files.write_partitions(rows, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(root).select("review_date", F.input_file_name().alias("f")).distinct()
    per_date = {r.review_date: r["count"] for r in written.groupBy("review_date").count().collect()}
    assert per_date["2021-01-01"] > 1 and spark.read.parquet(root).count() == 60_000


def test_merge_of_a_key_with_very_many_copies(spark):
    """A third of the rows are copies of one review."""
    rows = spark.range(90_000).select(
        F.lit("t").alias("text"), F.lit(1).alias("text_len"), F.lit(3.0).alias("rating"), F.lit("yelp").alias("source"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source_id"),
        F.lit("r").alias("restaurant"), F.lit("l").alias("location"), F.lit("2021-01-01").alias("date"),
        F.col("id").cast("string").alias("_ingested_at"),
    )
    merged = daily.merge_rows(daily.keyed(rows), daily.keyed(rows))
    assert merged.count() == 60_001
    assert merged.where("source_id = 'hot'").first()._ingested_at == "9999"


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and partitions count as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot():
    """Half of the rows share one id."""
    return F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 997).cast("string"))


def test_business_with_half_of_the_reviews_is_split(spark, shuffled):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("review_id"), hot().alias("business_id"), F.lit(3.0).alias("stars"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit("2021-01-01").alias("date"),
    )
    places = rows.select("business_id", F.lit("n").alias("name"), F.lit("c").alias("city")).distinct()
    df = refine.refine_joined(rows, places)
    assert len(df.collect()) == 60_000
    assert "skew=true" in plan(df)


def test_review_with_half_of_the_rows_is_split_and_not_paired(spark, shuffled):
    features = spark.range(0, 60_000, 1, 8).select(
        hot().alias("review_id"), F.lit("2021-01-01").alias("review_date"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    labels = features.select("review_id", F.lit("neutral").alias("label"), "review_date")
    df = gold.gold_rows(features, labels)
    assert len(df.collect()) == 60_000
    assert "skew=true" in plan(df)
    assert gold.training_frame(features, labels).count() == 60_000
