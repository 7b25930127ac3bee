import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import embeddings
from opinara.session import scratch_path

WORDS = ["soup", "rice", "tea", "waiter", "table", "cold", "warm", "lovely", "awful", "slow", "quick", "noodle", "cake", "queue", "bill"]


@pytest.fixture(scope="module")
def reviews(spark):
    """Texts with a few themes, so that singular values fall, and some without any term."""
    words = F.array(*map(F.lit, WORDS))
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000))
    theme = (F.col("id") % 3) * 5
    picks = [F.element_at(words, (theme + F.floor(F.sqrt(h(k) / 40.0)) % 5 + 1).cast("int")) for k in range(6)]
    noise = F.element_at(words, (h(99) % len(WORDS) + 1).cast("int"))
    text = F.when(F.col("id") % 50 == 7, None).when(F.col("id") % 50 == 8, "the of").otherwise(F.concat_ws(" ", *picks, noise))
    return spark.range(900).select(
        F.col("id").cast("string").alias("review_id"), text.alias("text"),
        F.concat(F.lit("2026-01-0"), F.col("id") % 4 + 1).alias("review_date"),
    ).repartition(7)


def matrix(reviews, fitted):
    n = len(fitted.terms.stages[2].vocabulary)
    out = {}
    for r in embeddings._rows(reviews, fitted.terms, ["review_id"]).collect():
        row = np.zeros(n)
        row[r._terms] = r._weights
        out[r.review_id] = row
    return out


@pytest.mark.parametrize("k", [3, 6])
def test_error_is_that_of_the_exact_decomposition(spark, reviews, k):
    fitted = embeddings.fit(reviews, k, oversample=4)
    rows = matrix(reviews, fitted)
    names = sorted(rows)
    a = np.array([rows[n] for n in names])
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    exact = np.linalg.norm(a - (u[:, :k] * s[:k]) @ vt[:k])
    own = np.linalg.norm(a - a @ fitted.axes @ fitted.axes.T)
    # Values that lie close together take more passes to come apart; the error does not.
    assert own <= 1.01 * exact and np.allclose(fitted.singular_values, s[:k], rtol=0.05)
    assert np.allclose(fitted.axes.T @ fitted.axes, np.eye(k), atol=1e-9)
    got = {r.review_id: np.array(r.embedding) for r in embeddings.embed(reviews, fitted).collect()}
    assert all(np.allclose(got[n], rows[n] @ fitted.axes, atol=1e-6) for n in names) and len(got) == 900
    assert not got["7"].any() and not got["8"].any()


def test_axes_do_not_depend_on_how_rows_are_dealt(spark, reviews):
    one, many = (embeddings.fit(reviews.repartition(n, "review_id"), 4, oversample=4) for n in (1, 40))  # as many as PARTS and more
    terms = [dict(zip(f.terms.stages[2].vocabulary, f.axes)) for f in (one, many)]
    assert all(np.allclose(terms[0][w], terms[1][w], atol=1e-6) for w in terms[0])


def test_vectors_are_stored_by_date_and_replaced_by_date(spark, reviews):
    fitted, root = embeddings.fit(reviews, 3), scratch_path(spark, "embeddings")
    embeddings.write_embeddings(reviews, root, fitted)
    again = reviews.where("review_date = '2026-01-02' AND review_id < '5'").unionByName(
        reviews.limit(1).withColumn("review_date", F.lit(None).cast("string"))
    )
    embeddings.write_embeddings(again, root, fitted)
    stored = embeddings.read_embeddings(spark, root)
    counts = {r.review_date: r["count"] for r in stored.groupBy("review_date").count().collect()}
    assert counts == {"2026-01-01": 225, "2026-01-02": again.count() - 1, "2026-01-03": 225, "2026-01-04": 225, "__null__": 1}
    assert embeddings.read_embeddings(spark, root, ["2026-01-03"]).where("size(embedding) = 3").count() == 225


def test_few_terms_and_no_rows(spark, reviews):
    few = spark.createDataFrame([("a", "tea", "d"), ("b", "tea rice", "d"), ("c", "tea tea", None)], "review_id string, text string, review_date string")
    fitted = embeddings.fit(few)
    assert fitted.axes.shape[1] <= 2
    assert embeddings.embed(few.where("false"), fitted).count() == 0
