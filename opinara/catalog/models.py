"""Training and scoring over the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import drift as drift_sql
from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.catalog.scalars import normalise_sql
from opinara.operators import drift, embeddings, model, topics
from opinara.plans import scoring
from opinara.session import scratch_path
from opinara.sources import tables

_FITTED: dict[tuple[str, str], model.Trained] = {}


def training_rows(spark, sf):
    return v.labelled(spark, sf).select("review_id", "text", "label", F.col("date").cast("timestamp").alias("ts"))


def trained(spark, sf) -> model.Trained:
    """One training run per session and data set; several queries score with it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = model.train(training_rows(spark, sf), "review_id", "ts")
    return _FITTED[key]


def forget() -> None:
    """Drop the training runs kept so far."""
    _FITTED.clear()


def dated_documents(spark, sf):
    return v.documents(spark, sf).withColumn("review_date", F.col("date"))


@query("m1_classifier_predictions", f"WITH {v.LABELLED} SELECT review_id, label, true AS known FROM g")
def classifier_predictions(spark, sf):
    """Every row gets one of the classes; which one is the fit's own affair."""
    t = trained(spark, sf)
    scored = model.predict(training_rows(spark, sf), t.model, t.classes)
    return scored.select("review_id", "label", F.coalesce(F.col("prediction").isin(t.classes), F.lit(False)).alias("known"))


@query("m2_class_weights", f"""WITH {v.LABELLED}
SELECT label, count(*) AS n_rows, round((SELECT count(*) FROM g)::DOUBLE / ((SELECT count(DISTINCT label) FROM g) * count(*)), 9) AS weight
FROM g GROUP BY label""")
def class_weights(spark, sf):
    return model.class_weights(v.labelled(spark, sf)).withColumn("weight", F.round("weight", 9))


@query("m2_class_weights_by_user", f"""WITH {v.EVENTS}
SELECT text, count(*) AS n_rows, round((SELECT count(*) FROM e)::DOUBLE / ((SELECT count(DISTINCT text) FROM e) * count(*)), 9) AS weight
FROM e GROUP BY text""")
def class_weights_by_user(spark, sf):
    """As many classes as there are users."""
    return model.class_weights(v.events(spark, sf), "text").withColumn("weight", F.round("weight", 9))


SPLIT_SIZES = f"""e AS (SELECT review_id, label, date::TIMESTAMP AS ts FROM g),
  k AS (SELECT greatest(1, round_even(count(ts) * 0.2::DOUBLE, 0)::BIGINT) AS n FROM e),
  c AS (SELECT ts AS cutoff FROM (SELECT ts, row_number() OVER (ORDER BY ts DESC) AS rn FROM e), k WHERE rn = n),
  i AS (SELECT label, count(*) AS n, round_even(count(*) * 0.2::DOUBLE, 0) AS n_test FROM e, c WHERE ts < cutoff GROUP BY label)
SELECT 'test' AS split, sum(n_test)::DOUBLE AS n_rows, true AS in_range FROM i
UNION ALL SELECT 'val', sum(round_even((n - n_test) * (0.15::DOUBLE / 0.8::DOUBLE), 0))::DOUBLE, true FROM i
UNION ALL SELECT 'oot', count(*)::DOUBLE, true FROM e, c WHERE ts >= cutoff"""


@query("m3_training_metrics", f"WITH {v.LABELLED}, {SPLIT_SIZES}")
def training_metrics(spark, sf):
    """Rows of each scored split, and that all its metrics are shares."""
    t = trained(spark, sf)
    names = ["accuracy", "f1_macro", "f1_weighted", "f1_neg", "precision_neg", "recall_neg"]
    rows = [
        (split, float(values["n_rows"]), all(0.0 <= float(values[n]) <= 1.0 for n in names))
        for split, values in t.metrics.items()
    ]
    return spark.createDataFrame(rows, "split string, n_rows double, in_range boolean")


def stored_by_day(reviews, classes):
    """Rows per stored day, and those with a class for a label."""
    return reviews.groupBy(v.day_text("ingested_at").alias("day")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("label").isin(classes)).alias("n_known")
    )


@query("m4_score_recent", f"""WITH {v.DOCUMENTS}
SELECT '{v.NOW[:10]}' AS day, count(*) AS n_rows, count(*) AS n_known FROM d
WHERE date IN (SELECT DISTINCT date FROM d ORDER BY date DESC LIMIT 30) AND {v.strip_sql("text")} <> ''""")
def score_recent(spark, sf):
    """Two runs over the newest dates leave the reviews of one."""
    t = trained(spark, sf)
    table = scratch_path(spark, "reviews")
    for _ in range(2):
        scoring.score_silver(spark, dated_documents(spark, sf), t.model, t.classes, table, v.NOW, n_partitions=30)
    return stored_by_day(tables.read_reviews(spark, table), t.classes)


@query("m5_score_scenario", f"""WITH {v.DOCUMENTS}, w AS (
  SELECT * FROM d WHERE date IN (SELECT DISTINCT date FROM d WHERE date <= '2024-06-30' ORDER BY date DESC LIMIT 60))
SELECT strftime(date::DATE + ('2026-06-30'::DATE - (SELECT max(date)::DATE FROM w))::INTEGER, '%Y-%m-%d') AS day,
  count(*) AS n_rows, count(*) AS n_known FROM w WHERE {v.strip_sql("text")} <> '' GROUP BY 1""")
def score_scenario(spark, sf):
    t = trained(spark, sf)
    table = scratch_path(spark, "reviews")
    scoring.score_replay(
        spark, dated_documents(spark, sf), t.model, t.classes, table, v.NOW, asof="2024-06-30", n=60, end="2026-06-30"
    )
    return stored_by_day(tables.read_reviews(spark, table), t.classes)


@query("m6_shadow_model", f"""WITH {v.LABELLED}
SELECT review_id, true AS sums_to_one, true AS known, true AS staged FROM g""")
def shadow_model(spark, sf):
    """The trained model's scores under both thresholds: probabilities, classes, stages."""
    t = trained(spark, sf)
    scored = model.probabilities(training_rows(spark, sf), t.model, t.classes)
    scores = {c: F.col(f"p_{c}") for c in t.classes}
    total = sum(scores.values(), F.lit(0.0))
    marked = scored.withColumn("sums_to_one", F.abs(total - 1) < 1e-9)
    known = F.col("production_label").isin(t.classes) & F.coalesce(F.col("staging_label").isin(t.classes), F.lit(True))
    return model.shadow_score(marked, scores, ["review_id", "sums_to_one"]).select(
        "review_id", "sums_to_one", known.alias("known"),
        (F.col("stage") == F.when(F.col("staging_label").isNull(), "production").otherwise("shadow")).alias("staged"),
    )


@query("m9_saved_model", f"""WITH {v.LABELLED} SELECT review_id, true AS same FROM g""")
def saved_model(spark, sf):
    """A saved and reloaded model labels every row as the original does."""
    t = trained(spark, sf)
    path = scratch_path(spark, "model")
    model.save(t.model, path)
    again = model.load(path)
    scored = model.predict(training_rows(spark, sf), t.model, t.classes, output="first")
    scored = model.predict(scored, again, t.classes, output="second")
    return scored.select("review_id", (F.col("first") == F.col("second")).alias("same"))


# ---------- texts that say their label, so that what a right model answers is known ----------

# Each event as a review: one of two words per label, among words that any label has.
WORDS = {"negative": ("awful", "rude"), "neutral": ("usual", "plain"), "positive": ("lovely", "tasty")}


def telling(spark, sf):
    word = F.coalesce(*[
        F.when(F.col("label") == label, F.element_at(F.array(*map(F.lit, words)), (F.col("id") % 2 + 1).cast("int")))
        for label, words in WORDS.items()
    ])
    said = F.concat(F.lit("The tea was "), word, F.lit(" today, said "), "text", F.lit(" at table "), F.col("id") % 40)
    return v.events(spark, sf).select("review_id", "id", said.alias("text"), "label", "ts", "review_date", "source")


def told(spark, sf) -> model.Trained:
    """Trained on a part of the telling reviews; the split is that of ``train``."""
    key = (spark.sparkContext.applicationId, f"{sf}#telling")
    if key not in _FITTED:
        _FITTED[key] = model.train(telling(spark, sf).select("review_id", "text", "label", "ts"), "review_id", "ts")
    return _FITTED[key]


@query("m1_told_labels", f"WITH {v.EVENTS} SELECT review_id, label, label AS prediction FROM e")
def told_labels(spark, sf):
    """Every row, also those held out, gets the label its words tell."""
    t = told(spark, sf)
    return model.predict(telling(spark, sf), t.model, t.classes).select("review_id", "label", "prediction")


TOLD_SIZES = SPLIT_SIZES.replace("e AS (SELECT review_id, label, date::TIMESTAMP AS ts FROM g),", "").replace(
    "true AS in_range", "1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1_macro, 1.0::DOUBLE AS f1_neg, 1.0::DOUBLE AS precision_neg, 1.0::DOUBLE AS recall_neg"
).replace(", true ", ", 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE ")


@query("m3_told_metrics", f"WITH {v.EVENTS}, {TOLD_SIZES}")
def told_metrics(spark, sf):
    """The metrics of held-out splits, by value."""
    names = ["n_rows", "accuracy", "f1_macro", "f1_neg", "precision_neg", "recall_neg"]
    rows = [(split, *(float(values[n]) for n in names)) for split, values in told(spark, sf).metrics.items()]
    return spark.createDataFrame(rows, "split string, " + ", ".join(f"{n} double" for n in names))


def labels_by_day(reviews):
    return reviews.groupBy(v.day_text("ingested_at").alias("day"), "label").agg(F.count("*").alias("n_rows"))


@query("m4_told_recent", f"""WITH {v.EVENTS}
SELECT '{v.NOW[:10]}' AS day, label, count(*) AS n_rows FROM e
WHERE review_date IN (SELECT DISTINCT review_date FROM e ORDER BY 1 DESC LIMIT 7) GROUP BY label""")
def told_recent(spark, sf):
    """Labels of the stored reviews, by value, after two runs over the newest dates."""
    t, table = told(spark, sf), scratch_path(spark, "reviews")
    for _ in range(2):
        scoring.score_silver(spark, telling(spark, sf), t.model, t.classes, table, v.NOW, n_partitions=7)
    return labels_by_day(tables.read_reviews(spark, table))


@query("m5_told_scenario", f"""WITH {v.EVENTS}, w AS (
  SELECT * FROM e WHERE review_date IN (SELECT DISTINCT review_date FROM e WHERE review_date <= '2024-01-20' ORDER BY 1 DESC LIMIT 10))
SELECT strftime(review_date::DATE + ('2026-06-30'::DATE - (SELECT max(review_date)::DATE FROM w))::INTEGER, '%Y-%m-%d') AS day,
  label, count(*) AS n_rows FROM w GROUP BY ALL""")
def told_scenario(spark, sf):
    t, table = told(spark, sf), scratch_path(spark, "reviews")
    scoring.score_replay(
        spark, telling(spark, sf), t.model, t.classes, table, v.NOW, asof="2024-01-20", n=10, end="2026-06-30"
    )
    return labels_by_day(tables.read_reviews(spark, table))


@query("m6_told_shadow", f"""WITH {v.EVENTS}
SELECT review_id, 'shadow' AS stage, label AS production_label, label AS staging_label, true AS sure FROM e""")
def told_shadow(spark, sf):
    """Both thresholds' labels, and that the told class has most of the probability."""
    t = told(spark, sf)
    scored = model.probabilities(telling(spark, sf), t.model, t.classes)
    scores = {c: F.col(f"p_{c}") for c in t.classes}
    sure = F.create_map(*[x for c in t.classes for x in (F.lit(c), scores[c])])[F.col("label")] > 0.5
    out = model.shadow_score(scored.withColumn("sure", sure), scores, ["review_id", "sure"])
    return out.select("review_id", "stage", "production_label", "staging_label", "sure")


TOLD_SIDES = v.EVENTS + f""", x AS (
  SELECT label, label AS prediction, false AS cur FROM e WHERE source IN ('error', 'view') AND ts < TIMESTAMP '{v.SPLIT_DAY}'
  UNION ALL SELECT label, label, true FROM e WHERE ts >= TIMESTAMP '{v.SPLIT_DAY}')"""


@query("k6_model_prediction_drift", lambda: f"""WITH {TOLD_SIDES}, {drift_sql.psi_sql([drift_sql.LABEL, ("prediction", "prediction", "prediction")])},
  z AS ({drift_sql.DRIFT_ROW}) SELECT *, {drift_sql.BLOCKED} FROM z""")
def model_prediction_drift(spark, sf):
    """Drift of a trained model's labels, and of the true ones: errors and views of old against all that is new."""
    t = told(spark, sf)
    scored = model.predict(telling(spark, sf), t.model, t.classes)
    old = scored.where(F.col("source").isin("error", "view") & (F.col("ts") < F.lit(v.SPLIT_DAY).cast("timestamp")))
    out = drift.drift_report(old, scored.where(F.col("ts") >= F.lit(v.SPLIT_DAY).cast("timestamp")), [], [])
    return drift_sql.rounded(out, *drift_sql.ROUNDED)


def document_frequency_sql() -> str:
    return f"""WITH {v.LABELLED}, t AS (
  SELECT DISTINCT review_id, unnest(regexp_extract_all({normalise_sql("text")}, '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM g)
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM g) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)), 9) AS idf
FROM t WHERE term NOT IN ({v.list_sql(v.spark_stopwords())}) GROUP BY term"""


@query("m8_document_frequencies", document_frequency_sql)
def document_frequencies(spark, sf):
    return model.document_frequencies(v.labelled(spark, sf)).withColumn("idf", F.round("idf", 9))


@query("m10_gold_embeddings", f"""WITH {v.EVENTS}
SELECT review_date, source, count(*) AS n_rows, round(sqrt((SELECT count(*) FROM e AS own WHERE own.source = e.source)), 4) AS singular_value,
  1.0::DOUBLE AS length FROM e GROUP BY ALL""")
def gold_embeddings(spark, sf):
    """Texts of one word each lie on axes of their own, whose singular values are the roots of their counts."""
    rows = v.events(spark, sf).select("review_id", "review_date", "source", F.col("source").alias("text"))
    fitted, root = embeddings.fit(rows, dimensions=8), scratch_path(spark, "embeddings")
    embeddings.write_embeddings(rows, root, fitted)
    values = F.array(*[F.lit(float(x)) for x in fitted.singular_values])
    size = F.transform("embedding", F.abs)
    axis = F.array_position(size, F.array_max(size)).cast("int")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    stored = embeddings.read_embeddings(spark, root).join(rows.select("review_id", "source"), "review_id")
    return stored.groupBy("review_date", "source").agg(
        F.count("*").alias("n_rows"), F.round(F.max(F.element_at(values, axis)), 4).alias("singular_value"),
        F.round(F.min(length), 5).alias("length"),
    )


def topic_coherence_sql() -> str:
    return f"""WITH {v.DOCUMENTS}, t AS (
  SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all({normalise_sql("text")}, '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM d),
l AS (SELECT lang AS topic, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS rank
  FROM t WHERE lang IS NOT NULL GROUP BY lang, term QUALIFY rank <= {topics.WORDS}),
o AS (SELECT l.topic, l.rank, t.doc_id FROM t JOIN l USING (term)),
s AS (SELECT topic, rank, count(*)::DOUBLE AS n FROM o GROUP BY ALL),
c AS (SELECT x.topic, x.rank AS a, y.rank AS b, count(*)::DOUBLE AS n FROM o x JOIN o y ON x.topic = y.topic AND x.doc_id = y.doc_id
  WHERE x.rank < y.rank GROUP BY ALL),
p AS (SELECT x.topic, c.n, x.n AS na, y.n AS nb, (SELECT count(*)::DOUBLE FROM d) AS total
  FROM s x JOIN s y ON x.topic = y.topic AND x.rank < y.rank LEFT JOIN c ON c.topic = x.topic AND c.a = x.rank AND c.b = y.rank)
SELECT topic, count(*) AS n_pairs, round(avg(CASE WHEN n IS NULL THEN -1.0::DOUBLE WHEN n = total THEN 1.0::DOUBLE
  ELSE ln(n * total / (na * nb)) / -ln(n / total) END), 9) AS coherence FROM p GROUP BY topic"""


@query("m11_topic_coherence", topic_coherence_sql)
def topic_coherence(spark, sf):
    """How far the words in most texts of a language go together over all texts."""
    docs = v.documents(spark, sf)
    found = topics.coherence(docs, topics.listed(topics.frequent_terms(docs, "lang")))
    return found.withColumn("coherence", F.round("coherence", 9))


@query("m11_told_topics", f"WITH {v.EVENTS} SELECT review_date, source AS theme, count(*) AS n_rows FROM e GROUP BY ALL")
def told_topics(spark, sf):
    """Texts of six words of one theme each: every topic keeps to a theme, every text is led by one of its own."""
    word = lambda k: F.concat("source", ((F.col("id") * (2 * k + 1) + 7 * k * k) % 12).cast("string"))
    rows = v.events(spark, sf).select("review_id", "review_date", F.concat_ws(" ", *[word(k) for k in range(6)]).alias("text"))
    fitted = topics.fit(rows, 12)
    themes = F.create_map(*[F.lit(x) for t, words in fitted.words(1).items() for x in (t, words[0].rstrip("0123456789"))])
    dated = topics.by_date(topics.assign(rows, fitted)).where("n_rows > 0")
    return dated.groupBy("review_date", themes[F.col("topic")].alias("theme")).agg(F.sum("n_rows").alias("n_rows"))
