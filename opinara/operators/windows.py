"""Recent-data selection: last partitions, as-of windows, last days, latest batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators.gold import labels_by_review
from opinara.plans.bounded import spread_sort
from opinara.schemas import NULL_KEY


def partition_counts(df: DataFrame, key: str = "review_date") -> DataFrame:
    """Rows per partition, dated keys in order, undated last."""
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.col(key) == NULL_KEY, key)


def reconcile(features: DataFrame, labels: DataFrame, key: str = "review_date") -> DataFrame:
    """Rows per partition in either store; a side without the partition counts 0."""
    f = features.groupBy(key).agg(F.count("*").alias("n_features"))
    lab = labels.groupBy(key).agg(F.count("*").alias("n_labels"))
    return f.join(lab, key, "full_outer").select(
        key,
        F.coalesce("n_features", F.lit(0)).alias("n_features"),
        F.coalesce("n_labels", F.lit(0)).alias("n_labels"),
    )


def recent_keys(df: DataFrame, n: int | None, key: str = "review_date", asof: str | None = None) -> list[str]:
    """The newest ``n`` dated partition keys up to ``asof``, newest first."""
    keys = df.select(key).where(F.col(key).isNotNull() & (F.col(key) != NULL_KEY))
    if asof:
        keys = keys.where(F.col(key) <= asof)
    ordered = keys.distinct().orderBy(F.desc(key))
    # One key per calendar day at most, and only the wanted ones reach the driver.
    return [r[0] for r in (ordered.limit(n) if n else ordered).collect()]


def recent_partitions(df: DataFrame, n: int, key: str = "review_date") -> DataFrame:
    """Rows of the newest ``n`` dated partitions; the literal keys prune the scan."""
    return df.where(F.col(key).isin(*recent_keys(df, n, key)))


def replay_window(
    df: DataFrame, asof: str | None = None, n: int | None = None, key: str = "review_date"
) -> DataFrame:
    """Dated partitions up to ``asof``, of those the newest ``n``. None at all is an error."""
    keys = recent_keys(df, n, key, asof)
    if not keys:
        raise ValueError(f"no partitions selected (asof={asof}, n={n})")
    dated = df.where(F.col(key) != NULL_KEY)
    return dated.where(F.col(key).between(min(keys), max(keys)))


def gold_window(features: DataFrame, labels: DataFrame, days: int) -> DataFrame:
    """The last ``days`` calendar days of Gold, dates both stores have, joined."""
    dated = features.where(F.col("review_date") != NULL_KEY)
    latest = dated.agg(F.max("review_date")).first()[0]
    if latest is None:
        return features.join(labels.drop("review_date"), "review_id").limit(0)
    floor = F.date_format(F.date_sub(F.lit(latest).cast("date"), days - 1), "yyyy-MM-dd")
    recent_f = dated.where(F.col("review_date") >= floor)
    recent_l = labels.where((F.col("review_date") >= floor) & (F.col("review_date") != NULL_KEY))
    # Calendar days on both sides: bounded by the number of days.
    in_f = [r[0] for r in recent_f.select("review_date").distinct().collect()]
    in_l = {r[0] for r in recent_l.select("review_date").distinct().collect()}
    both = [d for d in in_f if d in in_l]
    return recent_f.where(F.col("review_date").isin(*both)).join(
        labels_by_review(recent_l.where(F.col("review_date").isin(*both))), "review_id"
    )


def reviews_since(
    reviews: DataFrame, now: str, days: int, ts: str = "ingested_at", ordered: bool = True
) -> DataFrame:
    """Rows of the last ``days`` before ``now``, oldest first."""
    floor = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAY")
    recent = reviews.where(F.col(ts) >= floor)
    return spread_sort(recent, ts) if ordered else recent


def days_before_newest(df: DataFrame, days: int, ts: str = "review_date") -> DataFrame:
    """Rows from ``days`` before the newest one on; the bound belongs to the window."""
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None:
        return df.limit(0)
    return df.where(F.col(ts) >= F.lit(newest) - F.expr(f"INTERVAL {int(days)} DAY"))


def first_non_empty(candidates: Sequence) -> DataFrame:
    """The first candidate with rows; candidates are frames or functions giving one."""
    chosen = None
    for candidate in candidates:
        chosen = candidate() if callable(candidate) else candidate
        if chosen is not None and not chosen.isEmpty():
            return chosen
    return chosen


def load_reviews(
    warehouse: DataFrame | None, gold: tuple[DataFrame, DataFrame] | None, file: DataFrame | None,
    now: str, days: int,
) -> DataFrame:
    """Recent reviews from the warehouse, else Gold, else a file, each by its own rule."""
    columns = ["text", "label", "review_date"]

    def from_warehouse():
        if warehouse is None:
            return None
        return reviews_since(warehouse, now, days).select("text", "label", F.col("ingested_at").alias("review_date"))

    def from_gold():
        if gold is None:
            return None
        return gold_window(*gold, days).select("text", "label", F.col("review_date").cast("timestamp"))

    def from_file():
        if file is None:
            return None
        dated = file if "review_date" in file.columns else file.withColumnRenamed("date", "review_date")
        typed = dated.withColumn("review_date", F.col("review_date").try_cast("timestamp"))
        return days_before_newest(typed, days).select(*columns)

    return first_non_empty([from_warehouse, from_gold, from_file])


def latest_batch(df: DataFrame, ts: str = "review_date") -> DataFrame:
    """Rows of the newest day; everything when no row has a time."""
    newest = df.agg(F.date_trunc("day", F.max(ts))).first()[0]
    if newest is None:
        return df
    start = F.lit(newest)
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))
