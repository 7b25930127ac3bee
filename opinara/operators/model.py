"""Distributed text classifier: TF-IDF and multinomial logistic regression."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import text
from opinara.functions.labels import PRODUCTION_TAU, STAGING_TAU, label_from_scores
from opinara.operators import metrics, splits
from opinara.operators.analytics import label_distribution
from opinara.operators.refine import shift_dates
from opinara.operators.windows import recent_partitions, replay_window
from opinara.schemas import require
from opinara.session import stage

VOCABULARY = 5_000
MAX_ITERATIONS = 1_000


@dataclass(frozen=True)
class Trained:
    """Fitted model, its class order, and metrics per split."""

    model: PipelineModel
    classes: list[str]
    metrics: dict[str, dict]
    sizes: dict[str, int]

    @property
    def headline(self) -> dict:
        return self.metrics.get("test") or self.metrics.get("val") or {}


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))
    total, classes = counts.agg(F.sum("n_rows"), F.count("*")).first()
    return counts.select(
        F.col(label).cast("string").alias(label), "n_rows",
        (F.lit(float(total or 0)) / (F.lit(float(classes)) * F.col("n_rows"))).alias("weight"),
    )


def prepared(df: DataFrame) -> DataFrame:
    """Add the normalised text the vocabulary is built from."""
    return df.withColumn("clean_text", text.normalise(F.coalesce("text", F.lit(""))))


def build_stages(reg: float, vocabulary: int = VOCABULARY, iterations: int = MAX_ITERATIONS):
    """Tokens of two characters or more, English stop words out, length-normalised TF-IDF."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol="clean_text", outputCol="tokens", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False),
        StopWordsRemover(inputCol="tokens", outputCol="terms"),
        CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=vocabulary),
        IDF(inputCol="counts", outputCol="weighted"),
        Normalizer(inputCol="weighted", outputCol="features"),
        LogisticRegression(
            family="multinomial", labelCol="class_id", weightCol="weight", maxIter=iterations,
            regParam=reg, standardization=False,
        ),
    ])


def fit(df: DataFrame, vocabulary: int = VOCABULARY, iterations: int = MAX_ITERATIONS) -> tuple[PipelineModel, list[str]]:
    """Fit on ``text`` and ``label`` with balanced class weights."""
    require(df, ["text", "label"], "training frame")
    rows = prepared(df.where("text IS NOT NULL AND label IS NOT NULL")).select("clean_text", "label")
    # Weights, vocabulary, IDF and classifier all read the rows; normalise them once.
    rows = stage(rows, "training")
    # The model keeps a row of coefficients per class, so the driver can hold the classes.
    weights = class_weights(rows).collect()
    if not weights:
        raise ValueError("the training frame is empty")
    classes = sorted(w.label for w in weights)
    by_label = {w.label: w.weight for w in weights}
    total = sum(w.n_rows for w in weights)

    def lookup(values: Mapping):
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("label")]

    ready = rows.withColumns({
        "class_id": lookup({c: float(i) for i, c in enumerate(classes)}),
        "weight": lookup(by_label),
    })
    # Unit penalty on the summed loss, which Spark averages over the rows.
    model = build_stages(1.0 / total, vocabulary, iterations).fit(ready)
    return model, classes


def probabilities(df: DataFrame, model: PipelineModel, classes: list[str]) -> DataFrame:
    """Add ``p_<class>`` columns."""
    scored = model.transform(prepared(df)).withColumn("_p", vector_to_array("probability"))
    kept = [F.col(c) for c in df.columns]
    return scored.select(*kept, *[F.col("_p")[i].alias(f"p_{c}") for i, c in enumerate(classes)])


def predict(
    df: DataFrame, model: PipelineModel, classes: list[str], tau: float = PRODUCTION_TAU,
    output: str = "prediction",
) -> DataFrame:
    scored = probabilities(df, model, classes)
    scores = {c: F.col(f"p_{c}") for c in classes}
    tau = tau if "negative" in classes else 0.0
    return scored.withColumn(output, label_from_scores(scores, tau)).drop(*[f"p_{c}" for c in classes])


def shadow_score(scored: DataFrame, scores: Mapping[str, object], keep: list[str]) -> DataFrame:
    """Production and challenger labels of the same rows, as stage-tagged predictions."""
    both = scored.select(
        *keep,
        label_from_scores(scores, PRODUCTION_TAU).alias("production_label"),
        label_from_scores(scores, STAGING_TAU).alias("staging_label"),
    )
    return both.withColumn("stage", F.when(F.col("staging_label").isNull(), "production").otherwise("shadow"))


def stage_predictions(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per stage from a frame with both stages' labels."""
    return pairs.select(*keep, F.inline(F.array(
        F.struct(F.lit("Production").alias("stage"), F.col("production_label").alias("predicted_label")),
        F.struct(F.lit("Staging").alias("stage"), F.col("staging_label").alias("predicted_label")),
    )))


def train(
    df: DataFrame, key: str, ts: str | None, seed: int = 42, oot_frac: float = 0.2, val_frac: float = 0.15,
    test_frac: float = 0.2, tau: float = 0.0, vocabulary: int = VOCABULARY, iterations: int = MAX_ITERATIONS,
) -> Trained:
    """Split, fit on train, score every other split once, metrics per split."""
    require(df, ["text", "label"], "training frame")
    split = splits.train_val_test_oot(df, key, ts, "label", oot_frac, val_frac, test_frac, seed)
    sizes = {r.split: r["count"] for r in split.frame.groupBy("split").count().collect()}
    model, classes = fit(split.part("train"), vocabulary, iterations)
    scored = predict(split.frame.where("split <> 'train'"), model, classes, tau)
    per_split = metrics.summary(scored, by=["split"]).collect()
    results = {r.split: {k: x for k, x in r.asDict().items() if k != "split"} for r in per_split}
    return Trained(model, classes, results, sizes)


def score_recent(
    silver: DataFrame, model: PipelineModel, classes: list[str], now: str, n_partitions: int = 1,
    tau: float = PRODUCTION_TAU, as_now: bool = True,
) -> DataFrame:
    """Score the newest partitions into ``reviews`` rows."""
    scored = predict(recent_partitions(silver, n_partitions), model, classes, tau)
    return as_reviews(scored, "batch", now, as_now)


def score_scenario(
    stream: DataFrame, model: PipelineModel, classes: list[str], now: str, asof: str | None = None,
    n: int | None = None, end: str | None = None, tau: float = PRODUCTION_TAU, as_now: bool = False,
) -> DataFrame:
    """Score a replay window, optionally moved so that it ends on ``end``."""
    window = replay_window(stream, asof, n)
    if end:
        window = shift_dates(window, end)
    return as_reviews(predict(window, model, classes, tau), "replay", now, as_now)


def as_reviews(scored: DataFrame, source: str, now: str, as_now: bool) -> DataFrame:
    """Scored rows in the reviews table's columns, stamped ``now`` or by review date."""
    stamp = F.lit(now).cast("timestamp")
    when = stamp if as_now else F.coalesce(F.col("review_date").cast("string").try_cast("timestamp"), stamp)
    return scored.select(
        "text", F.col("prediction").alias("label"), F.lit(source).alias("source"), when.alias("ingested_at")
    )


def scoring_summary(scored: DataFrame) -> DataFrame:
    return label_distribution(scored)


def document_frequencies(df: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """Per term: in how many documents it is, and its IDF weight."""
    n_docs = df.count()
    terms = F.array_distinct(F.regexp_extract_all(text.normalise(F.col("text")), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1)))
    table = df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    table = table.where(~F.col("term").isin(*StopWordsRemover.loadDefaultStopWords("english")))
    weighted = table.withColumn("idf", F.ln(F.lit(n_docs + 1.0) / (F.col("df") + 1.0)))
    return weighted if vocabulary is None else weighted.orderBy(F.desc("df"), "term").limit(vocabulary)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)

