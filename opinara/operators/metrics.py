"""Classifier quality from a confusion table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(
    df: DataFrame, truth: str = "label", predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (label, prediction), and per ``by``; rows lacking either are left out."""
    return (
        df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by, F.col(truth).alias("label"), F.col(predicted).alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def per_class(confused: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 per label seen as truth or prediction; 0/0 is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = confused.select(*by, F.inline(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )))
    sums = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    tp, predicted, support = F.col("tp"), F.col("predicted"), F.col("support")
    return sums.select(
        *by,
        "label",
        support,
        predicted,
        tp,
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(tp * 2, predicted + support).alias("f1"),
    )


def summary(
    df: DataFrame, truth: str = "label", predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row (per ``by``): accuracy, macro and weighted F1, the negative class's figures.

    One shuffle over the data; everything after works on labels squared rows.
    """
    classes = per_class(confusion(df, truth, predicted, by), by)

    def negative(column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("label") == "negative", F.col(column))), F.lit(0.0))

    def share(top: Column) -> Column:
        return F.coalesce(F.try_divide(top, F.sum("support")), F.lit(0.0))

    return classes.groupBy(*by).agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("n_rows"),
        share(F.sum("tp")).alias("accuracy"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("f1_macro"),
        share(F.sum(F.col("f1") * F.col("support"))).alias("f1_weighted"),
        negative("f1").alias("f1_neg"),
        negative("precision").alias("precision_neg"),
        negative("recall").alias("recall_neg"),
    )


def quality_gate(metrics: DataFrame, min_f1_macro: float = 0.5) -> DataFrame:
    """May the model be promoted at all? No score means no."""
    passed = F.coalesce(F.col("f1_macro") >= min_f1_macro, F.lit(False))
    return metrics.withColumn("promote", passed)
