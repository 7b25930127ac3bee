import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import topics

THEMES = [["soup", "rice", "tea", "noodle", "cake"], ["waiter", "queue", "bill", "table", "menu"], ["parking", "street", "bus", "taxi", "train"]]


@pytest.fixture(scope="module")
def reviews(spark):
    """Texts of seven words of one theme, every fifth with two of another; some null or without a term."""
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(5)).cast("int") + 1
    words = F.array(*[F.array(*map(F.lit, t)) for t in THEMES])
    own = lambda shift: F.element_at(words, ((F.col("id") + shift) % 3 + 1).cast("int"))
    mine = F.concat_ws(" ", *[F.element_at(own(0), h(k)) for k in range(7)])
    other = F.concat_ws(" ", *[F.element_at(own(1), h(k)) for k in (8, 9)])
    text = F.when(F.col("id") % 5 == 0, F.concat_ws(" ", mine, other)).otherwise(mine)
    text = F.when(F.col("id") % 50 == 7, None).when(F.col("id") % 50 == 8, "the of").otherwise(text)
    return spark.range(600).select(
        F.col("id").cast("string").alias("review_id"), text.alias("text"), (F.col("id") % 3).alias("theme"),
        F.concat(F.lit("2026-01-0"), F.col("id") % 4 + 1).alias("review_date"),
    ).repartition(5)


@pytest.fixture(scope="module")
def fitted(reviews):
    return topics.fit(reviews, 3)


def plain_pass(texts, counts, alpha):
    """One iteration word by word; the derivative of the gamma function by differences of its logarithm."""
    n_terms, k = counts.shape
    slope = lambda x: (math.lgamma(x + 1e-5) - math.lgamma(x - 1e-5)) / 2e-5
    rate = lambda c, total: math.exp(slope(c) - slope(total))
    beta = [[rate(counts[w][t], counts[:, t].sum()) for t in range(k)] for w in range(n_terms)]
    out = np.zeros((n_terms, k))
    for text in texts:
        gamma = [alpha + sum(text.values()) / k] * k
        for _ in range(topics.STEPS):
            theta = [rate(g, sum(gamma)) for g in gamma]
            phi = {w: np.array([theta[t] * beta[w][t] for t in range(k)]) for w in text}
            gamma = [alpha + sum(n * phi[w][t] / phi[w].sum() for w, n in text.items()) for t in range(k)]
        theta = [rate(g, sum(gamma)) for g in gamma]
        for w, n in text.items():
            last = np.array([theta[t] * beta[w][t] for t in range(k)])
            out[w] += n * last / last.sum()
    return out


def test_a_pass_is_that_of_a_plain_loop(spark, reviews, fitted):
    few = reviews.where("review_id < '13'")
    rows = topics._counted(topics.prepared(few), fitted.terms, [])
    texts = [dict(zip(r._terms, r._counts)) for r in rows.collect()]
    counts = np.random.default_rng(3).gamma(2.0, 1.0, fitted.counts.shape) + 0.1
    own = topics._pass(rows.repartition(3), counts, 0.3)
    plain = plain_pass(texts, counts, 0.3)
    assert np.abs(own - plain).max() < 5e-3
    assert own.sum() == pytest.approx(sum(sum(t.values()) for t in texts))


def test_digamma():
    # Whole places differ from the first by a harmonic number; a half is a known value.
    known = {0.5: -np.euler_gamma - 2 * math.log(2)} | {n: sum(1 / k for k in range(1, n)) - np.euler_gamma for n in (1, 2, 30, 4000)}
    assert np.allclose(topics.digamma(np.array(list(known), float)), list(known.values()), rtol=1e-9)


def test_topics_are_the_themes_and_lead_their_texts(spark, reviews, fitted):
    words = fitted.words(5)
    assert sorted(sorted(w) for w in words.values()) == sorted(sorted(t) for t in THEMES)
    theme = {t: next(i for i, own in enumerate(THEMES) if w[0] in own) for t, w in words.items()}
    rows = {r.review_id: r for r in topics.assign(reviews, fitted, ["review_id", "theme"]).collect()}
    assert len(rows) == 600
    for key, r in rows.items():
        if int(key) % 50 in (7, 8):
            assert r.topic is None and r.topic_weights is None
        else:
            assert theme[r.topic] == r.theme and sum(r.topic_weights) == pytest.approx(1)


def test_the_fit_does_not_depend_on_how_rows_are_dealt(reviews, fitted):
    many = topics.fit(reviews.repartition(40, "review_id"), 3)
    at = {w: i for i, w in enumerate(many.vocabulary)}
    order = [at[w] for w in fitted.vocabulary]
    mine, other = (c / c.sum(axis=0) for c in (fitted.counts, many.counts[order]))
    # Topics may be numbered otherwise: terms of equal counts may take each other's place.
    assert all(min(np.abs(mine[:, t] - other[:, u]).max() for u in range(3)) < 1e-3 for t in range(3))


def test_by_date_counts_every_led_review_once(reviews, fitted):
    dated = topics.by_date(topics.assign(reviews, fitted)).collect()
    assert len(dated) == 12 and sum(r.n_rows for r in dated) == 576
    for date in {r.review_date for r in dated}:
        assert sum(r.mean_weight for r in dated if r.review_date == date) == pytest.approx(1)


def test_copies_and_one_very_long_text(spark):
    rows = [("same", "tea soup rice")] * 400 + [("long", "bus taxi " * 60_000)] + [("few", "queue bill")] * 3
    docs = spark.createDataFrame(rows, "review_id string, text string").withColumn("topic_", F.lit(1))
    fitted = topics.fit(docs, 3)
    led = {(r.review_id, r.topic) for r in topics.assign(docs, fitted, ["review_id"]).collect()}
    assert len(led) == 3 and len({t for _, t in led}) == 3


def test_more_topics_than_texts_and_no_rows(spark, reviews):
    docs = spark.createDataFrame([("a", "tea rice"), ("b", "bus taxi")], "review_id string, text string")
    fitted = topics.fit(docs, 6)
    assert fitted.counts.shape == (4, 6)
    assert topics.assign(docs.where("false"), fitted, ["review_id"]).count() == 0
    with pytest.raises(ValueError, match="term"):
        topics.fit(docs.where("false"), 2)
    with pytest.raises(ValueError, match="term"):
        topics.fit(docs.withColumn("text", F.lit(None).cast("string")), 2)


def test_coherence_against_brute_force(spark):
    texts = ["tea rice soup", "tea rice", "tea bus, tea", None, "", "bus", "Soup TEA", "rice"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    lists = {"x": ["tea", "rice", "soup"], "y": ["bus", "rice"], 3: ["tea"], "none": [], "never": ["tea", "absent"]}
    sets = [set((t or "").lower().replace(",", "").split()) for t in texts]
    share = lambda *w: sum(set(w) <= s for s in sets) / len(sets)

    def npmi(a, b):
        return -1.0 if not share(a, b) else math.log(share(a, b) / share(a) / share(b)) / -math.log(share(a, b))

    got = {r.topic: (r.n_pairs, r.coherence) for r in topics.coherence(docs, lists).collect()}
    for t, own in lists.items():
        pairs = [npmi(a, b) for a, b in combinations(own, 2)]
        n, value = got.pop(str(t))
        assert n == len(pairs) and (value is None if not pairs else value == pytest.approx(sum(pairs) / len(pairs)))
    assert not got
    everywhere = spark.createDataFrame([("tea rice",)] * 3, "text string")
    assert topics.coherence(everywhere, {"x": ["tea", "rice"]}).first().coherence == 1.0
    assert topics.coherence(everywhere.where("false"), {"x": ["tea", "rice"]}).first().coherence == -1.0
    assert topics.coherence(everywhere, {}).count() == 0


def test_frequent_terms_by_value(spark):
    docs = spark.createDataFrame(
        [("en", "tea tea rice"), ("en", "tea bus"), ("de", "bus"), (None, "tea"), ("de", None)], "lang string, text string"
    )
    assert topics.listed(topics.frequent_terms(docs, "lang", 2)) == {"en": ["tea", "bus"], "de": ["bus"]}
