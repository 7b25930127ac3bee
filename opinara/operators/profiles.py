"""Drift profiles: what drift scores need of each date, stored once and merged for any window.

A profile counts, for each date and column, the rows of each value: categories as they
are, numbers in cells of ``bits`` significant bits, with the least and largest number
seen in a cell. Profiles add up, so a window of dates is scored from their rows without
reading a review again, and a date that gets late reviews is profiled anew alone.

With 20 bits, integers below a million and decimals of up to six figures have cells of
their own, and scores and quantiles are those of the rows; others are known to a part in
``2 ** bits``. A column has at most ``2 ** bits`` cells for each power of two it spans,
however many rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import text
from opinara.operators.drift import (
    CATEGORICAL, FEW_VALUES, FLOOR, NUMERIC, PREDICTION, PSI_THRESHOLD, TARGET, blocking_report,
)
from opinara.operators.refine import monitoring_features, relabel
from opinara.operators.windows import recent_partitions
from opinara.schemas import NULL_KEY
from opinara.sources import files

BITS = 20
PROFILES = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("bin", T.StringType()),
    T.StructField("cell", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("review_date", T.StringType()),
])
_KEY = ["column", "bin", "cell"]
# Below this a number's cell is zero; its own width would vanish.
_TINY = 1e-290


def cell(x: Column, bits: int = BITS) -> Column:
    """The lower edge of a number's cell."""
    size = F.abs(x)
    width = F.pow(F.lit(2.0), F.floor(F.log2(size)) - F.lit(bits))
    edge = F.floor(x / width).cast("double") * width
    return F.when(size < _TINY, 0.0).when(size == float("inf"), x).otherwise(edge)


def profile(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = (*CATEGORICAL, TARGET),
    key: str = "review_date", bits: int = BITS,
) -> DataFrame:
    """Rows of each value of each column and date; columns ``df`` lacks are left out.

    Nulls and not-a-number are counted in a row without bin and cell, so every date has
    a row for every column. One shuffle, of at most a row per value, column, date and task.
    """
    number = lambda c: text.no_nan(F.col(c).cast("double"))
    none = F.lit(None)
    values = [
        F.struct(F.lit(c).alias("column"), none.cast("string").alias("bin"), cell(number(c), bits).alias("cell"), number(c).alias("value"))
        for c in numeric if c in df.columns
    ] + [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("bin"), none.cast("double").alias("cell"), none.cast("double").alias("value"))
        for c in categorical if c in df.columns
    ]
    day = F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY)).alias("review_date")
    long = df.select(day, F.explode(F.array(*values)).alias("v")).select("review_date", "v.*")
    counted = long.groupBy(*_KEY, "review_date").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    return counted.select(*PROFILES.fieldNames())


def write_profiles(df: DataFrame, root: str, **options) -> None:
    """Profile the dates of ``df``, whole, and replace just these under ``root``."""
    files.write_partitions(profile(df, **options), root)


def read_profiles(spark: SparkSession, root: str, keys: Sequence[str] | None = None) -> DataFrame:
    return files.read_partitions(spark, root, PROFILES, keys)


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """One profile of all dates: column, bin, cell, n, low, high."""
    return profiles.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _psi(sides: DataFrame, roles: Mapping[str, str], threshold: float, window: Sequence[str] = ()) -> DataFrame:
    """Scores of each column, for each ``window``, of profile rows with ``_side`` 0 (reference) or 1.

    Bins are those of ``drift.psi_by_column``, found from the cells.
    """
    known = sides.where(F.col("bin").isNotNull() | F.col("cell").isNotNull()).where(F.col("column").isin(*roles))
    side = lambda k: F.sum(F.when(F.col("_side") == k, F.col("n")).otherwise(0))
    cells = known.groupBy(*window, *_KEY).agg(
        side(0).alias("n_ref"), side(1).alias("n_cur"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    both = [*window, "column"]
    whole = cells.groupBy(*both).agg(
        F.min("low").alias("_low"), F.max("high").alias("_high"), F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"),
        F.count_if(F.col("n_ref") > 0).alias("_values"),
    )
    k = F.ceil(F.log2(F.col("_ref") + F.col("_cur"))) + 1
    at = F.floor((F.col("low") - F.col("_low")) / ((F.col("_high") - F.col("_low")) / k))
    one_by_one = (F.col("_values") <= FEW_VALUES) | (F.col("_high") == F.col("_low"))
    label = F.when(F.col("cell").isNull(), F.col("bin")).when(one_by_one, F.col("cell").cast("string")).otherwise(
        F.least(at, k - 1).cast("string")
    )
    binned = cells.join(whole, both).withColumn("_label", label).groupBy(*both, "_label", "_ref", "_cur").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    share = lambda n, of: F.greatest(F.try_divide(F.col(n).cast("double"), F.col(of)), F.lit(FLOOR))
    r, c = share("n_ref", "_ref"), share("n_cur", "_cur")
    score = F.when((F.col("_ref") > 0) & (F.col("_cur") > 0), (r - c) * F.ln(r / c)).otherwise(F.lit(0.0))
    role = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])[F.col("column")]
    psi = binned.groupBy(*both).agg(F.sum(score).alias("psi"))
    return psi.select(*window, "column", role.alias("role"), "psi", (F.col("psi") > threshold).alias("drifted"))


def roles_of(
    numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, target: str | None = TARGET, prediction: str | None = None,
) -> dict[str, str]:
    roles = {c: "feature" for c in (*numeric, *categorical)}
    return roles | {c: r for c, r in ((target, "target"), (prediction, "prediction")) if c}


def psi_of_profiles(
    reference: DataFrame, current: DataFrame, roles: Mapping[str, str] | None = None, threshold: float = PSI_THRESHOLD
) -> DataFrame:
    """``column, role, psi, drifted`` of two windows of stored profiles, for the columns both have."""
    own = lambda df, k: df.select(*_KEY, "n", "low", "high", F.lit(k).alias("_side"))
    shared = reference.select("column").distinct().join(current.select("column").distinct(), "column")
    both = own(reference, 0).unionByName(own(current, 1)).join(F.broadcast(shared), "column")
    return _psi(both, roles or roles_of(), threshold)


def psi_by_day(
    profiles: DataFrame, days: int = 7, roles: Mapping[str, str] | None = None, threshold: float = PSI_THRESHOLD
) -> DataFrame:
    """``review_date, column, role, psi, drifted``: every date against the ``days`` before it.

    Dates without any stored date in that time, and undated reviews, are left out. A
    profile row goes to its own date and to those it is a reference of: ``days + 1``
    copies at most, of counts, never of reviews.
    """
    dated = profiles.withColumn("_day", F.col("review_date").try_cast("date")).where("_day IS NOT NULL")
    copies = F.explode(F.sequence(F.lit(0), F.lit(days))).alias("_ahead")
    # A date to be scored is one that is stored.
    stored = dated.select(F.col("_day").alias("_of")).distinct()
    ahead = dated.select("*", copies).withColumn("_of", F.date_add("_day", F.col("_ahead")))
    sides = ahead.join(stored, "_of").withColumn("_side", (F.col("_ahead") == 0).cast("int"))
    scored = _psi(sides, roles or roles_of(), threshold, ["_of"])
    has_reference = sides.where("_side = 0").select("_of").distinct()
    out = scored.join(has_reference, "_of", "left_semi")
    return out.select(F.date_format("_of", "yyyy-MM-dd").alias("review_date"), "column", "role", "psi", "drifted")


def profile_quantiles(profiles: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``column, probability, value``: the least number with at least that share of a column's numbers up to it.

    Counts are summed up over the cells of a column in order; rows were summed before.
    The value is the cell's largest number, exact where a cell holds one.
    """
    cells = merge_profiles(profiles.where("cell IS NOT NULL"))
    order = Window.partitionBy("column").orderBy("cell")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("column"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    placed = cells.select("column", "cell", "n", "high", upto.alias("_upto"), total.alias("_total"))
    need = F.greatest(F.ceil(F.col("probability") * F.col("_total")), F.lit(1))
    hit = placed.select("*", wanted).where((F.col("_upto") >= need) & (F.col("_upto") - F.col("n") < need))
    return hit.select("column", "probability", F.col("high").alias("value"))


def write_monitoring_profiles(silver: DataFrame, root: str, **options) -> None:
    """Profile the monitored features and the derived label of Silver partitions, by their date."""
    features = monitoring_features(silver, ["review_date"])
    write_profiles(relabel(features) if "rating" in features.columns else features, root, **options)


def monitor_profiles(reference: DataFrame, stored: DataFrame, n_partitions: int = 7) -> DataFrame:
    """``drift.monitor`` from stored profiles: a reference's against the newest dates'."""
    current = recent_partitions(stored, n_partitions)
    return blocking_report(psi_of_profiles(reference, current, roles_of(prediction=PREDICTION)))
