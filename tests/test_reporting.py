from pyspark.sql import functions as F

from opinara.operators import analytics, windows
from tests.conftest import values


def hourly(spark, n=48):
    return spark.range(n).selectExpr(
        "timestamp_seconds(1767225600 + id * 3600) AS ingested_at",
        "element_at(array('positive', 'negative', 'neutral', cast(null as string)), cast(id % 4 + 1 as int)) AS label",
        "concat('text ', id) AS text", "'yelp' AS source", "cast(id as string) AS review_id",
    )


def test_timeline(spark):
    rows = analytics.sentiment_timeline(hourly(spark)).orderBy("period").collect()
    assert [r.n_reviews for r in rows] == [18, 18]
    assert abs(rows[0].pct_negative - 100 / 3) < 1e-9
    assert analytics.sentiment_timeline(hourly(spark), "W").count() == 1


def test_word_counts(frame):
    rows = frame([
        ("Cold food, slow SERVICE!", "negative"), ("The service was cold and slow", "negative"), ("cold drinks", "positive"),
    ], "text string, label string")
    assert values(analytics.negative_word_counts(rows), "word", "n") == [
        ("cold", 2), ("food", 1), ("service", 2), ("slow", 2),
    ]
    assert values(analytics.negative_word_counts(rows, 1, stopwords=["cold"]), "word", "n") == [("service", 2)]


def test_tiles_and_alert(spark):
    df = hourly(spark).where("label IS NOT NULL")
    tile = analytics.kpi_tiles(df, "ingested_at").first()
    assert (tile.batch_size, tile.window_size, tile.pct_negative, tile.status) == (18, 36, 33.3, "above threshold")
    assert analytics.spike_alert(df, "ingested_at").first().alert is True
    assert analytics.spike_alert(df, "ingested_at", 40).first().alert is False
    assert analytics.spike_alert(df.limit(0), "ingested_at").first().alert is False


def test_latest_batch_of_undated_rows_is_everything(spark):
    undated = hourly(spark).withColumn("ingested_at", F.lit(None).cast("timestamp"))
    assert windows.latest_batch(undated, "ingested_at").count() == 48


def test_newest_negatives(spark):
    rows = analytics.newest_negatives(hourly(spark), 2, "ingested_at").collect()
    assert [(r.review_id, r.snippet, r.source, r.day) for r in rows] == [
        ("45", "text 45", "Yelp", "02 Jan 2026"), ("41", "text 41", "Yelp", "02 Jan 2026"),
    ]


def test_stage_pairs_take_the_last_label(frame):
    rows = frame([
        (1, "a", "Production", "negative", "2026-01-01 00:00:00"), (2, "a", "Production", "positive", "2026-01-02 00:00:00"),
        (3, "a", "Staging", "positive", "2026-01-01 00:00:00"), (4, "b", "Production", "neutral", "2026-01-01 00:00:00"),
        (5, "c", "Production", "neutral", "2026-01-01 00:00:00"), (6, "c", "Staging", "negative", "2026-01-01 00:00:00"),
    ], "id long, text string, stage string, predicted_label string, at string").withColumn(
        "predicted_at", F.col("at").cast("timestamp"))
    pairs = analytics.paired_predictions(rows, now="2026-01-03 00:00:00")
    assert values(pairs, "production_label", "staging_label") == [("neutral", "negative"), ("positive", "positive")]
    row = analytics.shadow_agreement(pairs).first()
    assert (row.n, row.agree_pct, row.prod_neutral, row.stag_negative) == (2, 50.0, 1, 1)


def test_negative_volume_fills_gaps(frame):
    rows = frame([
        ("Production", "negative", "2026-01-01 10:00:00"), ("Production", "negative", "2026-01-03 10:00:00"),
        ("Production", "positive", "2026-01-02 10:00:00"),
    ], "stage string, predicted_label string, at string").withColumn("predicted_at", F.col("at").cast("timestamp"))
    got = analytics.negative_volume(rows, "2026-01-04 00:00:00")
    assert values(got, F.col("period").cast("string"), "Production", "Staging") == [
        ("2026-01-01", 1, 0), ("2026-01-02", 0, 0), ("2026-01-03", 1, 0),
    ]


def test_run_history(frame):
    runs = frame([("lr", 1, 0.5), ("lr", 2, 0.6), ("lr", 3, 0.55), ("bert", 1, 0.9)], "model string, x_ord int, f1_neg double")
    got = analytics.metric_delta(runs).first()
    assert (got.model, got.last, got.previous, round(got.delta, 6)) == ("lr", 0.55, 0.6, -0.05)
    versions = frame([
        ("r1", 1, "Archived"), ("r1", 2, "Production"), ("r2", 3, "None"), ("r2", 4, None), ("r3", 5, "canary"),
    ], "run_id string, version int, stage string")
    assert values(analytics.leaderboard(versions), "run_id", "version", "status") == [
        ("r1", 2, "production"), ("r2", 4, "archived"), ("r3", 5, "canary"),
    ]


def test_loader_falls_back_in_order(frame, spark):
    table = frame([("t", "neutral", "2026-01-09 00:00:00")], "text string, label string, at string").withColumn(
        "ingested_at", F.col("at").cast("timestamp"))
    f = frame([("a", "2026-01-01", "gold"), ("b", "2026-01-02", "gold 2")], "review_id string, review_date string, text string")
    lab = frame([("a", "2026-01-01", "neutral"), ("b", "2026-01-03", "neutral")],
                "review_id string, review_date string, label string")
    file = frame([("file", "neutral", "2026-01-05")], "text string, label string, date string")
    now = "2026-01-10 00:00:00"

    def first(*sources):
        return [r.text for r in windows.load_reviews(*sources, now=now, days=14).collect()]

    assert first(table, (f, lab), file) == ["t"]
    assert first(table.limit(0), (f, lab), file) == ["gold"]
    assert first(None, (f.limit(0), lab), file) == ["file"]
