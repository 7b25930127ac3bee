"""Quality classifier by co-training.

Two views of a document are classified apart: its text (shares of characters, words and
lines) and its page metadata (language, source, length as recorded). Both start from the
labelled rows. In each round each classifier labels the unlabelled rows it is surest of,
in the classes' proportions, and hands them to the other. In the end each is calibrated
on the labelled rows, and a last model weighs both calibrated scores.

Training holds a bounded sample on the driver as small numeric rows; scoring reads every
whole document in Spark tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import small_batches, text_bytes
from opinara.llm.pu_toxicity import held_out, sigmoid

#: Labelled and, as many, unlabelled documents that training reads at most (about).
SAMPLE = 6_000
ROUNDS = 4
#: Share of the unlabelled rows that a classifier labels for the other in a round.
HANDED = 0.05
BINS = 10
META_DIM = 512
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]


def text_features(text: bytes) -> list[float]:
    """Shares of characters, words and lines; zeros for an empty text."""
    if not text:
        return [0.0] * (len(_PUNCTUATION) + 9)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_words = max(1, len(words))
    wide = words[:-2] and len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, len(words) - 2)
    return [
        *(counts[_PUNCTUATION] / n).tolist(),
        counts[97:123].sum() / n, counts[65:91].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
        math.log1p(len(words)), sum(map(len, words)) / n_words, len(set(words)) / n_words,
        len(set(lines)) / max(1, len(lines)), wide or 0.0,
    ]


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """Buckets of the metadata and their pairs; null is a value of its own."""
    size = -1 if n_chars is None or n_chars < 0 else int(2 * math.log2(n_chars + 1))
    parts = (f"l={lang}", f"s={source}", f"n={size}")
    crossed = (*parts, f"{parts[0]}&{parts[1]}", f"{parts[0]}&{parts[2]}")
    return [zlib.crc32(c.encode("utf-8", "replace")) % META_DIM for c in crossed]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, rounds: int = 120, decay: float = 1e-3) -> np.ndarray:
    """Weights (the last is the intercept) by Newton-like steps with a diagonal bound."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, total = np.zeros(x.shape[1]), weight.sum()
    curve = 0.25 * (weight[:, None] * x * np.abs(x).sum(1, keepdims=True)).sum(0) / total + decay
    velocity = np.zeros_like(w)
    for _ in range(rounds):
        ahead = w + 0.9 * velocity
        slope = x.T @ (weight * (sigmoid(x @ ahead) - y)) / total + decay * np.append(ahead[:-1], 0)
        velocity = 0.9 * velocity - slope / curve
        w = w + velocity
    return w


@dataclass(frozen=True)
class CoModel:
    edges: np.ndarray  # inner bin edges of each text feature
    text: np.ndarray
    meta: np.ndarray
    calibration: np.ndarray  # slope and intercept of each view
    blend: np.ndarray  # weights of both calibrated margins, intercept

    def text_matrix(self, rows: np.ndarray) -> np.ndarray:
        return _binned(rows, self.edges)

    def margins(self, text_rows: np.ndarray, meta_rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        a = self.text_matrix(text_rows) @ self.text[:-1] + self.text[-1]
        b = _hashed(meta_rows) @ self.meta[:-1] + self.meta[-1]
        return self.calibration[0, 0] * a + self.calibration[0, 1], self.calibration[1, 0] * b + self.calibration[1, 1]

    def score(self, text_rows: np.ndarray, meta_rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.margins(text_rows, meta_rows)
        return sigmoid(a), sigmoid(b), sigmoid(self.blend[0] * a + self.blend[1] * b + self.blend[2])


def _edges(rows: np.ndarray) -> np.ndarray:
    return np.quantile(rows, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T


def _binned(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Steps: a column for each edge that a value exceeds, so effects need not be linear."""
    return (rows[:, :, None] > edges[None, :, :]).reshape(len(rows), -1).astype(np.float32)


def _hashed(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), META_DIM), np.float32)
    for i, r in enumerate(rows):
        out[i, r] = 1
    return out


def co_train(
    text_rows: np.ndarray, meta_rows: list[list[int]], labels: np.ndarray, *, rounds: int = ROUNDS, handed: float = HANDED
) -> CoModel:
    """Fit on rows with labels 0 and 1, and -1 for unlabelled."""
    edges = _edges(text_rows)
    views = [_binned(text_rows, edges), _hashed(meta_rows)]
    known = labels >= 0
    prior = labels[known].mean()
    own = [labels.astype(float).copy(), labels.astype(float).copy()]

    def fit(view: int, rows: np.ndarray) -> np.ndarray:
        # A row that the other view labelled counts half as much as a label.
        return fit_logistic(views[view][rows], own[view][rows], np.where(known[rows], 1.0, 0.5))

    for _ in range(rounds):
        models = [fit(v, np.flatnonzero(own[v] >= 0)) for v in range(2)]
        for v, other in ((0, 1), (1, 0)):
            open_ = np.flatnonzero(own[other] < 0)
            margin = views[v][open_] @ models[v][:-1] + models[v][-1]
            order = open_[np.argsort(margin, kind="stable")]
            n = int(handed * len(order))
            low, high = round(n * (1 - prior)), n - round(n * (1 - prior))
            # Only what is surer than the class's share is handed on.
            sure = dict(zip(open_, sigmoid(margin), strict=True))
            for i in order[:low]:
                if sure[i] < 0.2:
                    own[other][i] = 0
            for i in order[len(order) - high :]:
                if sure[i] > max(0.9, prior):
                    own[other][i] = 1
    models = [fit(v, np.flatnonzero(own[v] >= 0)) for v in range(2)]
    # Calibrate and blend on margins of rows that a fold's models have not seen.
    fold = np.arange(len(labels)) % 4
    out = np.zeros((2, len(labels)))
    for v in range(2):
        for k in range(4):
            test = np.flatnonzero(known & (fold == k))
            if len(test):
                w = fit(v, np.flatnonzero((own[v] >= 0) & (fold != k)))
                out[v, test] = views[v][test] @ w[:-1] + w[-1]
    y, one = labels[known].astype(float), np.ones(int(known.sum()))
    calibration = np.array([fit_logistic(out[v, known][:, None], y, one, decay=1e-4) for v in range(2)])
    both = np.stack([calibration[v, 0] * out[v, known] + calibration[v, 1] for v in range(2)], axis=1)
    return CoModel(edges, models[0], models[1], calibration, fit_logistic(both, y, one, decay=1e-4))


def quality(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", n_chars: str = "n_chars", label: str = "quality", sample: int = SAMPLE,
) -> DataFrame:
    """Per document: ``doc_id``, held_out, text_score, meta_score, score, predicted, kept.

    Scores are probabilities of good quality; ``kept`` is score >= 0.5. Labels of the
    held-out fifth are never learned; a document labelled twice is good only if all its
    labels are; null labels are none. Null metadata is a value of its own, a null text is
    empty; repeated rows are scored each; other columns are left out. If learned labels
    lack one of the classes, every score is the share of good labels (0.5 without any).
    ``sample`` bounds what training reads, not what is scored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = F.col(f"`{n_chars}`").cast("long")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), text_bytes(text).alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{source}`").cast("string").alias("source"), size.alias("n_chars"),
    )
    learned = (
        labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id"))
        .groupBy("id").agg(F.min("y").alias("y"))
    )
    total, good = learned.agg(F.count("*"), F.sum("y")).first()
    n_docs = docs.count()
    model = None
    share = (good or 0) / total if total else 0.5

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name).to_pylist() for name in ("text", "lang", "source", "n_chars")}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("y"),
                    pa.array([text_features(t) for t in at["text"]], pa.list_(pa.float64())),
                    pa.array([meta_features(*m) for m in zip(at["lang"], at["source"], at["n_chars"], strict=True)], pa.list_(pa.int32())),
                ],
                ["id", "y", "t", "m"],
            )

    if total and 0 < good < total and n_docs:
        drawn = lambda of: F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1, sample / of) * (1 << 30)) + 1
        # About ``sample`` ids: a proven bound for the broadcast.
        chosen = learned.where(drawn(total))
        picked = rows.join(F.broadcast(chosen), "id", "left").where(F.col("y").isNotNull() | drawn(n_docs))
        kind = docs.schema[doc_id].dataType.simpleString()
        got = picked.mapInArrow(features, f"id {kind}, y int, t array<double>, m array<int>").toPandas()
        got = got.sort_values(["id"], kind="stable")
        y = got["y"].fillna(-1).to_numpy().astype(int)
        if {0, 1} <= set(y.tolist()):
            model = co_train(np.stack(got["t"].to_list()), got["m"].to_list(), y)
    shared = spark.sparkContext.broadcast((model, share))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, share = shared.value
        for batch in batches:
            at = {name: batch.column(name).to_pylist() for name in ("text", "lang", "source", "n_chars")}
            n = batch.num_rows
            if model is None or not n:
                scores = [np.full(n, share)] * 3
            else:
                meta = [meta_features(*m) for m in zip(at["lang"], at["source"], at["n_chars"], strict=True)]
                scores = model.score(np.array([text_features(t) for t in at["text"]]), meta)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(s, pa.float64()) for s in scores]], ["id", "text_score", "meta_score", "score"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = rows.mapInArrow(score, f"id {kind}, text_score double, meta_score double, score double")
    return scored.select(
        F.col("id").alias(doc_id), held_out("id").alias("held_out"), "text_score", "meta_score", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"),
    )
