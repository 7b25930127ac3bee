"""Streaming operators that keep state: what they find, what they forget, what a repeated batch leaves."""

import pytest

from opinara.session import scratch_path
from opinara.sources.files import read_partitions
from opinara.streaming import jobs
from tests.conftest import values

ARRIVALS = "review_id string, ts string, text string"


@pytest.fixture
def feed(spark):
    """Lands files one after another and runs a job over what is new."""
    class Feed:
        def __init__(self, schema, *times):
            self.path, self.schema, self.times = scratch_path(spark, "feed"), schema, times
            self.land([])

        def land(self, rows):
            df = spark.createDataFrame(rows, self.schema)
            df.withColumns({t: df[t].cast("timestamp") for t in self.times}).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return jobs.read_files(spark, self.path, spark.read.parquet(self.path).schema, files_per_batch=1)

    return Feed


def state_rows(query):
    return [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]


def test_dedup_drops_repeats_within_lateness_and_then_forgets(spark, feed):
    source = feed(ARRIVALS, "ts")
    table, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")

    def run(*rows):
        source.land([*rows])
        query = jobs.append_batches(jobs.dedup(source.stream(), ["review_id"], "ts", "2 days"), table, checkpoint)
        query.awaitTermination()
        return query

    run(("a", "2026-01-01", "1"), ("b", "2026-01-02", "1"), ("a", "2026-01-01", "1"), ("u", None, "1"))
    query = run(("a", "2026-01-01", "2"), ("c", "2026-01-03", "1"), ("u", None, "2"))
    assert jobs.dropped_duplicates(query) == 1
    assert values(spark.read.parquet(table), "review_id", "text") == [("a", "1"), ("b", "1"), ("c", "1"), ("u", "1"), ("u", "2")]
    # Much later rows push the watermark past a, b and c: only the new ones stay in state.
    query = run(*((f"n{k}", "2026-03-01", "1") for k in range(3)))
    assert state_rows(query)[-1] == 3
    run(("c", "2026-03-01", "again"))
    assert ("c", "again") in values(spark.read.parquet(table), "review_id", "text")


def test_a_batch_run_again_lands_once(spark, feed):
    table = scratch_path(spark, "landed")
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "review_id string, text string")

    class Once:
        """A stream whose only batch is run twice, as after a failure between sink and checkpoint."""

        def __getattr__(self, name):
            return lambda *a, **k: self

        @property
        def writeStream(self):  # noqa: N802
            return self

        def foreachBatch(self, apply):  # noqa: N802
            apply(rows, 7)
            apply(rows, 7)
            return self

    jobs.append_batches(Once(), table, "nowhere")
    assert spark.read.parquet(table).count() == 2


REVIEWS = "review_id string, review_date string, label string, reviewed_at string"
CORRECTIONS = "id long, review_id string, corrected_label string, corrected_at string"


def test_corrections_in_any_order_and_reviews_that_settle(spark, feed):
    reviews, corrections = feed(REVIEWS, "reviewed_at"), feed(CORRECTIONS, "corrected_at")
    table, checkpoint = scratch_path(spark, "corrected"), scratch_path(spark, "checkpoint")

    def run(own=(), theirs=()):
        reviews.land([*own])
        corrections.land([*theirs])
        stream = jobs.corrected_labels(reviews.stream(), corrections.stream(), "10 days", "2 days")
        query = jobs.corrected_table(stream, table, checkpoint)
        query.awaitTermination()
        rows = values(read_partitions(spark, table, jobs.CORRECTED), "review_id", "label", "label_source", "settled")
        return query, {r[0]: r[1:] for r in rows}

    def review(name, day, label="positive"):
        return (name, day, label, day)

    # b's newest correction comes before its review, an older one after; c has none; d's is far too late.
    _, got = run([review("a", "2026-01-01"), review("c", "2026-01-01"), review("d", "2026-01-02")], [(5, "b", "neutral", "2026-01-04")])
    assert got == {k: ("positive", "derived_from_rating", False) for k in "acd"}
    _, got = run([review("b", "2026-01-02", "negative")], [(1, "a", "negative", "2026-01-02"), (2, "a", "neutral", "2026-01-02")])
    assert got["a"] == ("neutral", "human", False) and got["b"] == ("neutral", "human", False)
    _, got = run(theirs=[(4, "b", "positive", "2026-01-03"), (9, "d", "negative", "2026-01-25")])
    assert got["b"] == ("neutral", "human", False), "an older correction does not replace a newer one"
    assert got["d"][0] == "positive", "beyond the horizon"
    query, got = run([review("z", "2026-03-01")], [(10, "z", "negative", "2026-03-02"), (11, "zz", "negative", "2026-03-02")])
    query, got = run([review("y", "2026-03-02")], [(12, "yy", "negative", "2026-03-03")])
    assert got["c"] == ("positive", "derived_from_rating", True) and got["d"] == ("positive", "derived_from_rating", True)
    assert got["a"] == ("neutral", "human", False) and got["z"] == ("negative", "human", False)
    # Old reviews and corrections have left the state; a correction of a settled review changes nothing.
    assert state_rows(query)[-1] <= 6
    _, got = run([review("x", "2026-03-02")], [(13, "c", "negative", "2026-01-05")])
    assert got["c"] == ("positive", "derived_from_rating", True)


def test_corrected_table_keeps_undated_reviews_and_ties(spark, feed):
    reviews, corrections = feed(REVIEWS, "reviewed_at"), feed(CORRECTIONS, "corrected_at")
    reviews.land([("a", None, "positive", "2026-01-01"), ("a", None, "positive", "2026-01-01"), ("n", "2026-01-01", None, "2026-01-01")])
    corrections.land([(1, "a", "negative", "2026-01-02"), (1, "a", "negative", "2026-01-02"), (2, None, "neutral", "2026-01-02")])
    table = scratch_path(spark, "corrected")
    jobs.corrected_table(jobs.corrected_labels(reviews.stream(), corrections.stream()), table, scratch_path(spark, "c")).awaitTermination()
    got = read_partitions(spark, table, jobs.CORRECTED)
    assert values(got, "review_id", "label", "review_date") == [("a", "negative", "__null__"), ("n", None, "2026-01-01")]
