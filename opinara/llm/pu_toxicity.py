"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; any other text, labelled or not, is
unlabelled. A linear model over words and parts of words is trained in numpy on the risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

The second term estimates the risk on clean text; where it falls below zero the step
goes the other way, so that the model gains nothing from overfitting it. Only the
features that tell positives from unlabelled text best take part, so that long clean
texts gather no noise.

Training reads a bounded sample of documents, drawn by a hash of the id; scoring reads
every whole document and holds the weights only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import Memory, forget, free_name, kept, small_batches, text_bytes
from opinara.session import stage

#: Positive and, as many, unlabelled documents that training reads at most (about).
SAMPLE = 8_000
#: Positives that have a feature, at least: this number, and this share.
LEAST, LEAST_SHARE = 5, 0.005
#: Estimated share of positives among the texts with a feature, at least.
PURITY = 0.5
_WORD = re.compile(r"[^\W_]+")


def grams(word: str) -> set[int]:
    """Hashes of a word, its parts of four and five letters, and its beginnings."""
    marked = f"^{word}$"
    cut = {marked, *(marked[:n] for n in (6, 7, 8))}
    cut.update(marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1))
    return {zlib.crc32(c.encode("utf-8", "replace")) for c in cut}


def words(text: bytes) -> set[str]:
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


class Features:
    """Numbers of the chosen features in texts, through a memory of words."""

    #: In bytes.
    MEMORY = 32 << 20

    def __init__(self, chosen: np.ndarray):
        self.numbers = {int(h): k for k, h in enumerate(chosen)}
        self.memory = Memory(self.MEMORY)

    def learn(self, new: list[str]) -> dict[str, tuple[int, ...]]:
        numbers = self.numbers
        return {w: tuple(numbers[h] for h in grams(w) if h in numbers) for w in new}

    def __call__(self, text: bytes) -> list[int]:
        own = words(text)
        known = self.memory.recall(own, self.learn)
        return sorted(set().union(*map(known.__getitem__, own)))


@dataclass(frozen=True)
class Model:
    """Hashes of the features, their weights, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


NEVER = Model(np.empty(0, np.int64), np.empty(0), -35.0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_nnpu(
    positive: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float, *,
    rounds: int = 300, rate: float = 0.05, decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and intercept under the sigmoid loss; rows are lists of feature numbers.

    Adam over the whole sample, from weights that let one feature decide: every feature
    given is likelier positive than not, and the risk takes down those that are not.
    """

    def matrix(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.fromiter((f for r in rows for f in r), np.int64)
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), flat

    (pr, pc), (ur, uc) = matrix(positive), matrix(unlabelled)
    n_pos, n_unl = len(positive), len(unlabelled)
    w = np.full(n_features + 1, 3.0)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        sp = sigmoid(w[-1] + np.bincount(pr, w[pc], n_pos))
        su = sigmoid(w[-1] + np.bincount(ur, w[uc], n_unl))
        dp, du = sp * (1 - sp) / n_pos, su * (1 - su) / n_unl
        if su.mean() - prior * sp.mean() >= 0:
            dp, du = -2 * prior * dp, du
        else:
            dp, du = prior * dp, -du
        slope = np.zeros_like(w)
        slope[:-1] = np.bincount(pc, dp[pr], n_features) + np.bincount(uc, du[ur], n_features) + decay * w[:-1]
        slope[-1] = dp.sum() + du.sum()
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Fit the model on labels outside the held-out fifth.

    The prior is the share of positives among the learned labels (null labels are none;
    a document labelled twice is positive if any label is). Without positives, or without
    features that tell them apart, the model scores everything 0. ``sample`` bounds what training reads, not what the model scores.
    """
    spark = docs.sparkSession
    small_batches(spark)
    learned = (
        labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
        .groupBy("id").agg(F.max("y").alias("y"))
    )
    total, positives = learned.agg(F.count("*"), F.count(F.when(F.col("y") == 1, 1))).first()
    n_docs = docs.count()
    if not positives or not n_docs:
        return NEVER
    prior = min(max(positives / total, 1e-4), 0.9)

    def drawn(of: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1, sample / of) * (1 << 30)) + 1

    # About ``sample`` ids: a proven bound for the broadcast.
    chosen = learned.where((F.col("y") == 1) & drawn(positives)).select("id", F.lit(True).alias("positive"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), text_bytes(text).alias("text"))
    picked = stage(
        rows.join(F.broadcast(chosen), "id", "left")
        .withColumn("unlabelled", F.coalesce(drawn(n_docs), F.lit(False)))
        .where(F.col("positive").isNotNull() | F.col("unlabelled"))
        .select("text", F.coalesce("positive", F.lit(False)).alias("positive"), "unlabelled"),
        "pu-sample",
    )
    # A text that many positives share counts once.
    positive = picked.where("positive").select("text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen: Counter[int] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(set().union(*map(grams, words(t))))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["gram", "n"])

    n_pos, n_unl = positive.count(), picked.where("unlabelled").count()
    common = (
        positive.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(LEAST, LEAST_SHARE * n_pos))
    )
    found = {r["gram"]: r["n"] for r in common.collect()}  # as many as a bounded sample has
    if not found or not n_unl:
        return NEVER
    candidates = np.array(sorted(found), np.int64)

    def numbered(texts: DataFrame, chosen: np.ndarray) -> DataFrame:
        """Numbers of the chosen features in each text."""
        shared = spark.sparkContext.broadcast(chosen)

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            features = _features(shared.value)
            for batch in batches:
                own = [features(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], ["x"])

        return texts.select("text").mapInArrow(number, "x array<int>")

    among_unl = np.zeros(len(candidates))
    in_unl = numbered(picked.where("unlabelled"), candidates).select(F.explode("x").alias("f")).groupBy("f").count()
    for row in in_unl.collect():
        among_unl[row["f"]] = row["count"]
    among_pos = np.array([found[int(h)] for h in candidates])
    purity = prior * (among_pos / n_pos) / ((among_unl + 1) / n_unl)
    kept = candidates[purity > PURITY]
    if not len(kept):
        return NEVER
    # One order whatever the order of tasks.
    samples = [sorted(r["x"] for r in numbered(texts, kept).collect()) for texts in (positive, picked.where("unlabelled"))]
    weights, intercept = fit_nnpu(*samples, len(kept), prior)
    return Model(kept, weights, intercept)


def _features(chosen: np.ndarray) -> Features:
    """The worker's features and memory, kept between its tasks."""
    return kept(("pu_toxicity", zlib.crc32(chosen.tobytes())), lambda: Features(chosen))


def score(docs: DataFrame, model: Model, *, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with ``column`` (0 to 1, higher: likelier toxic) over whole texts.

    A column of that name is replaced, all others and repeated rows stay. Null and empty
    texts get the score of a text without words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    own = free_name("_bytes", docs)
    kept = [c for c in docs.columns if c != column]
    base = docs.select(*[F.col(f"`{c}`") for c in kept], text_bytes(text).alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = _features(model.features)
        for batch in batches:
            margins = [model.intercept + model.weights[features(t)].sum() for t in batch.column(own).to_pylist()]
            scores = pa.array(sigmoid(np.array(margins, float)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, scores], [*kept, column])

    fields = [f for f in base.schema.fields if f.name != own]
    return base.mapInArrow(run, T.StructType([*fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Per document: ``doc_id``, held_out, score, predicted (1 from a score of 0.5)."""
    model = train(docs, labels, doc_id=doc_id, text=text, label=label, sample=sample)
    rows = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("text"))
    return score(rows, model, text="text").select(
        F.col(f"`{doc_id}`"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` without rows that score 0.5 or more; same columns."""
    # The document as one column: no name of its own meets one of the scores'.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col(f"`{text}`").alias("text"))
    return score(rows, model, text="text").where(F.col("score") < 0.5).select("document.*")
