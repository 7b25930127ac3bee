"""Decision thresholds and calibration from counted scores.

Scores are counted in bins once; the curve, the chosen threshold and the calibration are
worked out on the bins, which a parameter bounds whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 1000


def score_bins(df: DataFrame, score: str, positive: str, bins: int = BINS) -> DataFrame:
    """``bin, n, n_positive`` over scores from 0 to 1; rows without score or truth are left out."""
    at = F.greatest(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)), F.lit(0)).cast("long")
    known = df.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(positive).isNotNull())
    return known.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.count_if(F.col(positive)).alias("n_positive"))


def precision_recall(counted: DataFrame, bins: int = BINS) -> DataFrame:
    """``threshold, n_predicted, n_hit, precision, recall, f1`` with each bin's lower edge as threshold."""
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)  # a row per bin
    whole = Window.partitionBy()
    out = counted.select(
        (F.col("bin") / bins).alias("threshold"), F.sum("n").over(down).alias("n_predicted"),
        F.sum("n_positive").over(down).alias("n_hit"), F.sum("n_positive").over(whole).alias("_positive"),
    )
    return out.select(
        "threshold", "n_predicted", "n_hit", (F.col("n_hit") / F.col("n_predicted")).alias("precision"),
        F.try_divide("n_hit", "_positive").alias("recall"),
        (F.col("n_hit") * 2 / (F.col("n_predicted") + F.col("_positive"))).alias("f1"),
    )


def choose_threshold(curve: DataFrame, least_recall: float | None = None) -> DataFrame:
    """One row of the curve: the best F1, or the best precision with at least a recall; ties take the higher threshold."""
    fits = curve if least_recall is None else curve.where(F.col("recall") >= least_recall)
    goal = "f1" if least_recall is None else "precision"
    names = curve.columns
    best = fits.agg(F.max_by(F.struct(*names), F.struct(goal, "threshold")).alias("r"))
    return best.where("r IS NOT NULL").select("r.*")


def isotonic(counted: DataFrame) -> DataFrame:
    """``bin, probability``: the rising step function closest to the bins' shares of positives.

    Neighbours that fall are pooled until none does. The bins come to the driver, at most
    as many as were asked for.
    """
    pools: list[list] = []
    for r in counted.orderBy("bin").collect():
        pools.append([r.n_positive, r.n, [r.bin]])
        # Shares as products, so that equal ones compare equal.
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            hits, n, own = pools.pop()
            pools[-1] = [pools[-1][0] + hits, pools[-1][1] + n, pools[-1][2] + own]
    rows = [(b, hits / n) for hits, n, own in pools for b in own]
    return counted.sparkSession.createDataFrame(rows, "bin long, probability double")


def calibrate(df: DataFrame, steps: DataFrame, score: str, output: str = "calibrated", bins: int = BINS) -> DataFrame:
    """Add each score's calibrated probability; scores between counted bins take the bin below, or the first."""
    known = [(r.bin, r.probability) for r in steps.orderBy("bin").collect()]
    if not known:
        return df.withColumn(output, F.lit(None).cast("double"))
    # A value per possible bin, looked up by place.
    values, now = [], 0
    for b in range(bins):
        while now + 1 < len(known) and known[now + 1][0] <= b:
            now += 1
        values.append(known[now][1])
    at = F.greatest(F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    table = F.from_json(F.lit(str(values)), "array<double>")
    return df.withColumn(output, F.when(F.col(score).isNotNull() & ~F.isnan(score), F.get(table, at)))
