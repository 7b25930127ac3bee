"""Batch scoring into the stored reviews: select, score, replace the last days, sum up."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from opinara.functions.labels import PRODUCTION_TAU
from opinara.operators import model
from opinara.session import stage
from opinara.sources import tables


def _store(
    spark: SparkSession, scored: DataFrame, path: str, now: str, clear_days: int, truncate: bool
) -> DataFrame:
    """Score once, store the rows, report the predicted labels."""
    ready = stage(scored, "scored")
    tables.store_reviews(spark, path, ready, now, clear_days, truncate)
    return model.scoring_summary(ready)


def score_silver(
    spark: SparkSession, silver: DataFrame, fitted: PipelineModel, classes: list[str], reviews_path: str,
    now: str, n_partitions: int = 1, tau: float = PRODUCTION_TAU, clear_days: int = 1, as_now: bool = True,
) -> DataFrame:
    """The newest Silver dates, scored in place of the last ``clear_days`` of reviews."""
    scored = model.score_recent(silver, fitted, classes, now, n_partitions, tau, as_now)
    return _store(spark, scored, reviews_path, now, clear_days, False)


def score_replay(
    spark: SparkSession, stream: DataFrame, fitted: PipelineModel, classes: list[str], reviews_path: str,
    now: str, asof: str | None = None, n: int | None = None, end: str | None = None,
    tau: float = PRODUCTION_TAU, clear_days: int = 0, truncate: bool = False, as_now: bool = False,
) -> DataFrame:
    """A replay window, scored into the reviews; ``end`` moves its last day there."""
    scored = model.score_scenario(stream, fitted, classes, now, asof, n, end, tau, as_now)
    return _store(spark, scored, reviews_path, now, clear_days, truncate)
