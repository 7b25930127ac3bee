"""Topics of reviews: variational inference over term counts, and how well topic words go together.

Latent Dirichlet allocation by variational Bayes. An iteration is one pass: each batch of
rows finds the topic weights of its texts under the current topics, and the tasks' expected
counts of terms by topics are summed by blocks of terms. What the driver and each task hold
is terms by topics, which the vocabulary bounds whatever the corpus. Topics start from texts
that are unlike each other, so the fit does not depend on how rows are dealt to tasks.

Coherence is an ordinary aggregate: a document gives the pairs of listed terms it holds,
counted before the shuffle into at most one row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import text
from opinara.operators.embeddings import MATRICES, added_up, entries, in_blocks
from opinara.operators.model import VOCABULARY, build_stages, prepared
from opinara.session import stage

TOPICS = 20
ITERATIONS = 30
#: The fit ends before ``ITERATIONS`` once no topic's distribution of terms moves by more in sum.
MOVED = 1e-3
#: Steps towards a text's topic weights, fewer once no weight of the texts at hand moves by ``SETTLED``.
STEPS = 50
SETTLED = 1e-4
#: Different texts, by a hash of their terms, among which the fit looks for its starts.
STARTS = 2_000
#: Entries of a batch that are worked on together.
ENTRIES = 100_000
#: Listed words of a topic.
WORDS = 10


@dataclass(frozen=True)
class Topics:
    """Fitted term counts, the terms in order, and pseudo-counts with a row per term and a column per topic."""

    terms: PipelineModel
    vocabulary: list[str]
    counts: np.ndarray

    def words(self, n: int = WORDS) -> dict[int, list[str]]:
        """The ``n`` heaviest words of each topic, heaviest first, equals by word."""
        order = np.argsort(np.array(self.vocabulary), kind="stable")
        shares = self.counts / self.counts.sum(axis=0)
        return {
            t: [self.vocabulary[i] for i in order[np.argsort(-shares[order, t], kind="stable")][:n]]
            for t in range(self.counts.shape[1])
        }


def digamma(x: np.ndarray) -> np.ndarray:
    """The logarithmic derivative of the gamma function at positive places: six steps up, then its series."""
    y = x + 6
    z = 1 / (y * y)
    series = np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132))))
    return series - sum(1 / (x + k) for k in range(6))


def expected(counts: np.ndarray, axis: int) -> np.ndarray:
    """The exponential of the expected logarithm under Dirichlet ``counts`` along ``axis``."""
    return np.exp(digamma(counts) - digamma(counts.sum(axis=axis, keepdims=True)))


def _weights(owner: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, topics: np.ndarray, alpha: float):
    """Pseudo-counts of the topics of ``n`` texts, and the texts' expected counts of terms by topics per entry."""
    own = topics[terms]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    gamma = np.full((n, topics.shape[1]), alpha)
    sizes = np.bincount(owner, weights=counts, minlength=n)
    gamma += sizes[:, None] / topics.shape[1]
    if not len(owner):
        return gamma, own
    for _ in range(STEPS):
        mixed = expected(gamma, 1)[owner] * own
        mixed *= (counts / mixed.sum(axis=1))[:, None]
        moved = np.full_like(gamma, alpha)
        moved[owner[starts]] += np.add.reduceat(mixed, starts)
        change = np.abs(moved - gamma).max()
        gamma = moved
        if change < SETTLED:
            break
    mixed = expected(gamma, 1)[owner] * own
    return gamma, mixed * (counts / mixed.sum(axis=1))[:, None]


def _pieces(owner: np.ndarray, n: int) -> Iterator[tuple[int, int, slice]]:
    """Consecutive rows of a batch with about ``ENTRIES`` entries: first row, row behind, entries."""
    ends = np.searchsorted(owner, np.arange(n), side="right")
    row = at = 0
    while row < n:
        last = max(int(np.searchsorted(ends, at + ENTRIES, side="right")), row + 1)
        yield row, last, slice(at, int(ends[last - 1]))
        row, at = last, int(ends[last - 1])


def _counted(df: DataFrame, terms: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``keep``, and the row's terms and their counts as arrays."""
    vectors = terms.transform(df).select(*keep, F.unwrap_udt("counts").alias("_v"))
    return vectors.select(*keep, F.col("_v.indices").alias("_terms"), F.col("_v.values").alias("_counts"))


def _starts(rows: DataFrame, topics: int, n_terms: int) -> np.ndarray:
    """Texts unlike each other as first topics: each next one has the least cosine to those before.

    They are looked for among the ``STARTS`` different texts of least hash.
    """
    hashed = rows.withColumn("_hash", F.xxhash64("_terms", "_counts"))
    least = [r[0] for r in hashed.select("_hash").distinct().orderBy("_hash").limit(STARTS).collect()]
    found = hashed.where(F.col("_hash").isin(least)).groupBy("_hash").agg(
        F.min(F.struct("_terms", "_counts")).alias("_row")
    )
    texts = np.zeros((len(least), n_terms), np.float32)
    for k, r in enumerate(sorted(found.collect(), key=lambda r: r["_hash"])):
        texts[k, r["_row"]["_terms"]] = r["_row"]["_counts"]
    texts /= np.linalg.norm(texts, axis=1, keepdims=True)
    nearest, picked = np.zeros(len(texts), np.float32), []
    for _ in range(topics):
        nxt = int(np.argmin(np.round(nearest, 5)))
        picked.append(nxt)
        nearest = np.maximum(nearest, texts @ texts[nxt])
    return texts[picked].T.astype(float)


def fit(
    df: DataFrame, topics: int = TOPICS, vocabulary: int = VOCABULARY, iterations: int = ITERATIONS,
    alpha: float | None = None, eta: float | None = None,
) -> Topics:
    """Fit ``topics`` topics on all texts of ``df``; texts that are null or hold no term say nothing.

    ``alpha`` and ``eta`` are the pseudo-counts of every topic in a text and of every term
    in a topic, one by the number of topics unless given.
    """
    alpha, eta = alpha or 1 / topics, eta or 1 / topics
    stages = build_stages(0.0, vocabulary).getStages()[:3]
    clean = prepared(df.select("text"))
    terms = Pipeline(stages=stages).fit(clean)
    names = list(terms.stages[2].vocabulary)
    # Every iteration reads the counts; the texts are cut into terms once.
    rows = stage(_counted(clean, terms, []).where(F.size("_terms") > 0), "topic-terms")
    if not names or rows.isEmpty():
        raise ValueError("no text holds a term")
    counts = eta + _starts(rows, topics, len(names))
    for _ in range(iterations):
        moved = eta + _pass(rows, counts, alpha)
        change = np.abs(moved / moved.sum(axis=0) - counts / counts.sum(axis=0)).sum(axis=0).max()
        counts = moved
        if change < MOVED:
            break
    return Topics(terms, names, counts)


def _pass(rows: DataFrame, counts: np.ndarray, alpha: float) -> np.ndarray:
    """The expected counts of terms by topics of all rows under topics ``counts``."""
    shared = rows.sparkSession.sparkContext.broadcast(expected(counts, 0))
    shape = counts.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, np.zeros(shape)
        for batch in batches:
            owner, terms, times = entries(batch, 0)
            for first, end, at in _pieces(owner, batch.num_rows):
                mixed = _weights(owner[at] - first, terms[at], times[at], end - first, own, alpha)[1]
                order = np.argsort(terms[at], kind="stable")
                if len(order):
                    sorted_ = terms[at][order]
                    starts = np.flatnonzero(np.diff(sorted_, prepend=-1))
                    total[sorted_[starts]] += np.add.reduceat(mixed[order], starts)
        yield in_blocks(total)

    out = added_up(rows.select("_terms", "_counts").mapInArrow(run, MATRICES), shape)
    shared.unpersist()
    return out


def assign(df: DataFrame, topics: Topics, keep: Sequence[str] = ("review_id", "review_date"), alpha: float | None = None) -> DataFrame:
    """``keep``, ``topic`` (the heaviest, the least of equals) and ``topic_weights`` of each row of ``df``.

    Texts that are null or hold no known term have neither. ``keep`` names neither of the two.
    """
    n_topics = topics.counts.shape[1]
    alpha = alpha or 1 / n_topics
    shared = df.sparkSession.sparkContext.broadcast(expected(topics.counts, 0))
    rows = _counted(prepared(df.select(*keep, *([] if "text" in keep else ["text"]))), topics.terms, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            owner, terms, times = entries(batch, len(keep))
            parts = [
                _weights(owner[at] - first, terms[at], times[at], end - first, own, alpha)[0]
                for first, end, at in _pieces(owner, batch.num_rows)
            ]
            gamma = np.concatenate(parts) if parts else np.zeros((0, n_topics))
            known = np.bincount(owner, minlength=batch.num_rows) > 0
            weights = gamma / gamma.sum(axis=1, keepdims=True)
            leads = np.round(weights, 9).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)], pa.array(leads.astype(np.int32), pa.int32(), mask=~known),
                    pa.array([w if k else None for w, k in zip(weights, known)], pa.list_(pa.float64())),
                ],
                [*keep, "topic", "topic_weights"],
            )

    fields = [T.StructField("topic", T.IntegerType()), T.StructField("topic_weights", T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(run, T.StructType([*[df.schema[c] for c in keep], *fields]))


def by_date(assigned: DataFrame, date: str = "review_date") -> DataFrame:
    """Per date and topic: reviews whose heaviest topic it is, and its mean weight over all reviews of the date.

    Topics no review of the date leads have a row too; reviews without a topic are left out.
    """
    rows = assigned.where("topic IS NOT NULL").select(date, "topic", F.posexplode("topic_weights").alias("_topic", "_weight"))
    return rows.groupBy(date, F.col("_topic").alias("topic")).agg(
        F.count_if(F.col("_topic") == F.col("topic")).alias("n_rows"), F.avg("_weight").alias("mean_weight")
    )


def distinct_terms(column: str = "text") -> Column:
    """The different terms of a text, as document frequencies count them; null has none."""
    found = F.regexp_extract_all(text.normalise(F.col(column)), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def frequent_terms(df: DataFrame, by: str, n: int = WORDS) -> DataFrame:
    """Per value of ``by``: ``topic``, ``rank`` and ``term`` of the ``n`` terms in most documents, ties by term."""
    terms = df.where(F.col(by).isNotNull()).select(F.col(by).alias("topic"), F.explode(distinct_terms()).alias("term"))
    counts = terms.groupBy("topic", "term").agg(F.count("*").alias("df"))
    order = Window.partitionBy("topic").orderBy(F.desc("df"), "term")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("topic", "rank", "term")


def listed(terms: DataFrame) -> dict[str, list[str]]:
    """Word lists by topic from ``frequent_terms``: topics by words."""
    out: dict[str, list[str]] = {}
    for r in terms.orderBy("topic", "rank").collect():
        out.setdefault(r.topic, []).append(r.term)
    return out


def pair_counts(df: DataFrame, lists: Mapping[object, Sequence[str]]) -> DataFrame:
    """In how many documents of ``df`` two words of a list meet: ``topic``, ``a``, ``b``, ``n_docs``.

    ``a`` is not behind ``b`` in the list; a pair of a word with itself counts its documents.
    Pairs that never meet have no row.
    """
    words = F.array(*[
        F.struct(F.lit(str(t)).alias("topic"), F.array(*[F.lit(w) for w in own]).alias("words"))
        for t, own in lists.items() if own
    ])

    def pairs(found: Column) -> Column:
        behind = lambda k: F.slice(found["words"], k + 1, F.size(found["words"]))
        return F.flatten(F.transform(found["words"], lambda a, k: F.transform(
            behind(k), lambda b: F.struct(found["topic"].alias("topic"), a.alias("a"), b.alias("b"))
        )))

    present = F.transform(words, lambda t: F.struct(
        t["topic"].alias("topic"), F.array_intersect(t["words"], F.col("_terms")).alias("words")
    ))
    met = df.select(distinct_terms().alias("_terms")).select(present.alias("_present"))
    return met.select(F.inline(F.flatten(F.transform("_present", pairs)))).groupBy("topic", "a", "b").agg(
        F.count("*").alias("n_docs")
    )


def coherence(df: DataFrame, lists: Mapping[object, Sequence[str]]) -> DataFrame:
    """How far the words of each list meet in documents of ``df``: ``topic``, ``n_pairs``, ``coherence``.

    The mean normalised pointwise mutual information of the list's pairs, from -1 (never
    together) to 1 (only together). Pairs that never meet count -1, pairs in every
    document 1. Every row of ``df`` is a document. Lists of under two words have null.
    """
    lists = {t: list(dict.fromkeys(own)) for t, own in lists.items()}
    spark = df.sparkSession
    total = float(df.count())
    wanted = [(str(t), own[i], own[k]) for t, own in lists.items() for i in range(len(own)) for k in range(i + 1, len(own))]
    schema = "topic string, a string, b string"
    if not any(lists.values()):
        return _means(spark, lists, spark.createDataFrame([], f"{schema}, npmi double"))
    # At most a row per listed pair.
    counts = stage(pair_counts(df, lists), "topic-pairs")
    single = counts.where("a = b")
    of = lambda side, name: single.select("topic", F.col("a").alias(side), F.col("n_docs").alias(name))
    pairs = (
        spark.createDataFrame(wanted, schema).join(counts, ["topic", "a", "b"], "left")
        .join(of("a", "n_a"), ["topic", "a"], "left").join(of("b", "n_b"), ["topic", "b"], "left")
    )
    both = F.col("n_docs") / F.lit(total)
    mutual = F.ln(F.col("n_docs") * F.lit(total) / (F.col("n_a") * F.col("n_b").cast("double")))
    npmi = F.when(F.col("n_docs").isNull(), -1.0).when(F.col("n_docs") == total, 1.0).otherwise(mutual / -F.ln(both))
    return _means(spark, lists, pairs.select("topic", "a", "b", npmi.alias("npmi")))


def _means(spark: SparkSession, lists: Mapping[object, Sequence[str]], pairs: DataFrame) -> DataFrame:
    topics = spark.createDataFrame([(str(t),) for t in lists], "topic string")
    means = pairs.groupBy("topic").agg(F.count("*").alias("n"), F.avg("npmi").alias("coherence"))
    return topics.join(means, "topic", "left").select("topic", F.coalesce("n", F.lit(0).cast("long")).alias("n_pairs"), "coherence")
