import pytest
from pyspark.sql import functions as F

from opinara.operators import model
from opinara.plans import scoring
from opinara.sources import tables
from tests.conftest import values

WORDS = {"negative": "awful cold rude slow", "neutral": "okay average plain usual", "positive": "great lovely warm tasty"}


@pytest.fixture(scope="module")
def reviews(spark):
    """Texts whose words give their label away, among shared filler."""
    said = F.create_map(*[F.lit(x) for pair in WORDS.items() for x in pair])
    labels = F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(240).select(
        F.col("id").cast("string").alias("key"), labels.alias("label"),
        F.concat(F.lit("The tea was "), F.element_at(F.split(said[labels], " "), (F.col("id") % 4 + 1).cast("int")),
                 F.lit(" today number "), F.col("id") % 10).alias("text"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 8).cast("int")).cast("timestamp").alias("ts"),
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 8).cast("int")), "yyyy-MM-dd").alias(
            "review_date"),
    )


@pytest.fixture(scope="module")
def trained(reviews):
    return model.train(reviews, "key", "ts", iterations=50)


def test_held_out_rows_are_labelled_well(trained):
    assert set(trained.metrics) == {"val", "test", "oot"}
    assert trained.headline["f1_macro"] > 0.9 and trained.headline is trained.metrics["test"]
    assert sum(trained.sizes.values()) == 240


def test_saved_model_predicts_the_same(reviews, trained, tmp_path):
    path = str(tmp_path / "model")
    model.save(trained.model, path)
    first = model.predict(reviews, trained.model, trained.classes)
    second = model.predict(reviews, model.load(path), trained.classes)
    assert values(first, "key", "prediction") == values(second, "key", "prediction")
    assert first.columns == [*reviews.columns, "prediction"]


def test_lower_threshold_finds_no_fewer_negatives(reviews, trained):
    def negatives(tau):
        return model.predict(reviews, trained.model, trained.classes, tau).where("prediction = 'negative'").count()

    assert negatives(0.2) >= negatives(0.46) >= negatives(0.9)


def test_scoring_windows(reviews, trained):
    now = "2026-06-06 00:00:00"
    recent = model.score_recent(reviews, trained.model, trained.classes, now, 2)
    assert recent.count() == 16 and recent.select("source").distinct().first()[0] == "batch"
    moved = model.score_scenario(reviews, trained.model, trained.classes, now, asof="2026-01-10", n=3, end="2026-06-30")
    assert values(moved.select(F.date_format("ingested_at", "yyyy-MM-dd").alias("d")).distinct(), "d") == [
        ("2026-06-28",), ("2026-06-29",), ("2026-06-30",),
    ]


def test_rescoring_replaces_the_last_day_only(spark, reviews, trained, tmp_path):
    path = str(tmp_path / "reviews")

    def days():
        kept = tables.read_reviews(spark, path).groupBy(F.date_format("ingested_at", "yyyy-MM-dd HH").alias("h"))
        return {r.h: r["count"] for r in kept.count().collect()}

    def score(now, n, **options):
        return scoring.score_silver(spark, reviews, trained.model, trained.classes, path, now, n, **options)

    score("2026-06-01 10:00:00", 1)
    score("2026-06-05 06:00:00", 1)
    assert days() == {"2026-06-01 10": 8, "2026-06-05 06": 8}
    summary = score("2026-06-05 20:00:00", 2)
    assert days() == {"2026-06-01 10": 8, "2026-06-05 20": 16}
    assert sum(r.n_rows for r in summary.collect()) == 16
    score("2026-06-06 21:00:00", 1)
    assert days() == {"2026-06-01 10": 8, "2026-06-05 20": 16, "2026-06-06 21": 8}
    score("2026-06-06 22:00:00", 1, clear_days=0)
    assert days()["2026-06-06 21"] == 8 and days()["2026-06-06 22"] == 8
    scoring.score_replay(
        spark, reviews, trained.model, trained.classes, path, "2026-06-07 00:00:00", asof="2026-01-10", n=1, truncate=True
    )
    assert days() == {"2026-01-10 00": 8}


def test_class_weights(frame):
    rows = frame([("a",), ("a",), ("a",), ("b",), (None,)], "label string")
    assert values(model.class_weights(rows), "label", "n_rows", F.round("weight", 6)) == [
        ("a", 3, 0.666667), ("b", 1, 2.0),
    ]


def test_empty_training_frame_raises(frame):
    with pytest.raises(ValueError, match="empty"):
        model.fit(frame([], "text string, label string"))


def test_document_frequencies(frame):
    rows = frame([("Tea tea TEA and cake!",), ("tea, please",), ("x cake-shop",)], "text string")
    assert values(model.document_frequencies(rows), "term", "df") == [("cake", 2), ("please", 1), ("shop", 1), ("tea", 2)]
