"""Dense vectors of reviews: a randomised truncated SVD of their TF-IDF rows.

The rows stay where they are. A pass multiplies them, a batch at a time, with a matrix of
one row per term and a few dozen columns, and sums up the product with their transpose;
two to four passes over a random start find the range that holds the largest singular
values (subspace iteration). What the driver and each task hold is terms by columns, which
the vocabulary bounds whatever the corpus; the sum of the tasks' matrices runs over blocks
of terms in two steps, so no task gathers all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.model import VOCABULARY, build_stages, prepared
from opinara.schemas import NULL_KEY
from opinara.session import stage
from opinara.sources import files

DIMENSIONS = 32
OVERSAMPLE = 10
PASSES = 4
#: Terms whose rows of a product travel together.
BLOCK = 256
#: Tasks' matrices are summed in so many parts, then the parts.
PARTS = 32
#: Rows of a matrix on its way to the driver.
MATRICES = "block int, part int, matrix binary"

EMBEDDINGS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("review_date", T.StringType()),
])


@dataclass(frozen=True)
class Embedder:
    """Fitted TF-IDF, the axes (a row per term, a column per dimension) and their singular values."""

    terms: PipelineModel
    axes: np.ndarray
    singular_values: np.ndarray


def _rows(df: DataFrame, terms: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``keep``, and the row's terms and weights as arrays."""
    vectors = terms.transform(prepared(df)).select(*keep, F.unwrap_udt("features").alias("_v"))
    return vectors.select(*keep, F.col("_v.indices").alias("_terms"), F.col("_v.values").alias("_weights"))


def entries(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every entry of a batch."""
    terms, weights = batch.column(at), batch.column(at + 1)
    sizes = np.diff(terms.offsets.to_numpy())
    return np.repeat(np.arange(batch.num_rows), sizes), terms.flatten().to_numpy(), weights.flatten().to_numpy()


def _times(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """The batch's rows times ``matrix``; entries come ordered by row."""
    out = np.zeros((n, matrix.shape[1]))
    if len(rows):
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[starts]] = np.add.reduceat(weights[:, None] * matrix[terms], starts)
    return out


def summed(partials: DataFrame, keys: Sequence[str], columns: int) -> DataFrame:
    """Matrices (bytes) with the same ``keys`` added up, one at a time."""
    dealt = partials.select("block", "part", "matrix").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([now[-1]], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                ["block", "part", "matrix"],
            )

        for batch in batches:
            for block, part, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                key = (block, part) if "part" in keys else (block, 0)
                if key != now:
                    if now:
                        yield out()
                    now, total = key, np.zeros((len(matrix) // (8 * columns), columns))
                total += np.frombuffer(matrix).reshape(total.shape)
        if now:
            yield out()

    return dealt.mapInArrow(run, MATRICES)


def in_blocks(matrix: np.ndarray) -> pa.RecordBatch:
    """A task's matrix of a row per term as rows of ``MATRICES``."""
    part = TaskContext.get().partitionId() % PARTS
    blocks = range(0, len(matrix), BLOCK)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k // BLOCK for k in blocks], pa.int32()), pa.array([part] * len(blocks), pa.int32()),
            pa.array([matrix[k : k + BLOCK].tobytes() for k in blocks], pa.binary()),
        ],
        ["block", "part", "matrix"],
    )


def added_up(partials: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of all tasks' matrices. Terms by columns: the vocabulary bounds it."""
    sums = summed(summed(partials, ["block", "part"], shape[1]), ["block"], shape[1])
    found = {r.block: np.frombuffer(r.matrix).reshape(-1, shape[1]) for r in sums.collect()}
    return np.concatenate([found[k] for k in sorted(found)]) if found else np.zeros(shape)


def _gram_times(rows: DataFrame, matrix: np.ndarray) -> np.ndarray:
    """The rows' transpose times the rows times ``matrix``, in one pass over the rows."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(matrix)
    n_terms, columns = matrix.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros((n_terms, columns))
        for batch in batches:
            owner, terms, weights = entries(batch, 0)
            product = _times(owner, terms, weights, batch.num_rows, own)
            order = np.argsort(terms, kind="stable")
            if len(order):
                starts = np.flatnonzero(np.diff(terms[order], prepend=-1))
                total[terms[order][starts]] += np.add.reduceat(weights[order, None] * product[owner[order]], starts)
        yield in_blocks(total)

    product = added_up(rows.select("_terms", "_weights").mapInArrow(run, MATRICES), matrix.shape)
    shared.unpersist()
    return product


def fit(
    df: DataFrame, dimensions: int = DIMENSIONS, vocabulary: int = VOCABULARY, passes: int = PASSES,
    oversample: int = OVERSAMPLE, seed: int = 42,
) -> Embedder:
    """Fit TF-IDF and the axes on all texts of ``df``; null texts are empty.

    The axes are orthonormal, by falling singular value, each with its largest entry
    positive. There are at most as many as terms.
    """
    stages = build_stages(0.0, vocabulary).getStages()[:-1]
    terms = Pipeline(stages=stages).fit(prepared(df))
    n_terms = len(terms.stages[2].vocabulary)
    rows = stage(_rows(df, terms, []), "tfidf")
    width = min(n_terms, dimensions + oversample)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_gram_times(rows, basis))[0]
    small = basis.T @ _gram_times(rows, basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(values)[::-1][:dimensions]
    axes = basis @ turn[:, best]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Embedder(terms, axes * np.where(signs == 0, 1, signs), np.sqrt(np.maximum(values[best], 0)))


def embed(df: DataFrame, embedder: Embedder, keep: Sequence[str] = ("review_id", "review_date")) -> DataFrame:
    """``keep`` and ``embedding``: each text's TF-IDF row along the axes. Texts without a known term are zero."""
    spark = df.sparkSession
    axes = spark.sparkContext.broadcast(embedder.axes)
    rows = _rows(df, embedder.terms, keep)
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = axes.value
        for batch in batches:
            product = _times(*entries(batch, len(keep)), batch.num_rows, own).astype(np.float32)
            ends = np.arange(0, product.size + 1, own.shape[1], dtype=np.int32) if own.shape[1] else np.zeros(batch.num_rows + 1, np.int32)
            vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(product.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], vectors], [*keep, "embedding"])

    return rows.mapInArrow(run, T.StructType([*fields, EMBEDDINGS["embedding"]]))


def write_embeddings(features: DataFrame, root: str, embedder: Embedder) -> None:
    """Store the vectors of Gold features by review date; the dates of ``features`` are replaced."""
    vectors = embed(features.select("review_id", "review_date", "text"), embedder)
    dated = vectors.withColumn("review_date", F.coalesce("review_date", F.lit(NULL_KEY)))
    files.write_partitions(dated.select(*EMBEDDINGS.fieldNames()), root)


def read_embeddings(spark: SparkSession, root: str, keys: Sequence[str] | None = None) -> DataFrame:
    return files.read_partitions(spark, root, EMBEDDINGS, keys)
