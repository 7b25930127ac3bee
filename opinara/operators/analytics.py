"""Reporting: timelines, tiles, word counts, model comparison, run history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from opinara.functions import dates, keys, text
from opinara.functions.fixed import REVIEW_STOPWORDS
from opinara.operators.windows import latest_batch
from opinara.plans.bounded import spread_sort
from opinara.schemas import require

# Negative share (%) that raises an alert; order of model stages.
ALERT_PERCENT = 25.0
STAGE_ORDER = {"production": 0, "staging": 1, "archived": 2, "none": 3}


def percent_of(label: str) -> Column:
    """Share of rows with ``label``, in percent."""
    return F.avg(F.when(F.col("label") == label, F.lit(100.0)).otherwise(F.lit(0.0)))


# ---------- timelines ----------

def sentiment_timeline(df: DataFrame, freq: str = "D", ts: str = "ingested_at") -> DataFrame:
    """Reviews and label shares per day or week."""
    require(df, [ts, "label"], "timeline input")
    rows = df.where(F.col(ts).isNotNull() & F.col("label").isNotNull())
    return rows.groupBy(dates.period(F.col(ts), freq).alias("period")).agg(
        F.count("*").alias("n_reviews"),
        percent_of("positive").alias("pct_positive"),
        percent_of("negative").alias("pct_negative"),
        percent_of("neutral").alias("pct_neutral"),
    )


def daily_negative_share(df: DataFrame, key: str = "review_date") -> DataFrame:
    negative = F.when(F.col("label") == "negative", F.lit(1.0)).otherwise(F.lit(0.0))
    return df.groupBy(key).agg(F.count("*").alias("n_rows"), F.avg(negative).alias("negative_share"))


def time_order(df: DataFrame, key: str = "review_date", ident: str = "review_id") -> DataFrame:
    """Rows in event order, equal dates by id."""
    return spread_sort(df, key, ident)


def stream_summary(df: DataFrame, key: str = "review_date") -> DataFrame:
    """Size, span, label counts and the worst day (the earliest of equals)."""
    daily = df.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("label") == lb).alias(lb) for lb in ("negative", "neutral", "positive")],
    )
    share = F.col("negative") / F.col("n")
    worst = F.min_by(F.struct(F.col(key).alias("day"), share.alias("share")), F.struct(-share, F.col(key)))
    return daily.agg(
        F.sum("n").alias("n_rows"),
        F.min(key).alias("first_date"),
        F.max(key).alias("last_date"),
        *[F.sum(lb).alias(f"n_{lb}") for lb in ("negative", "neutral", "positive")],
        worst.alias("w"),
    ).select("*", F.col("w.day").alias("peak_day"), F.col("w.share").alias("peak_share")).drop("w")


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percent per label."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    # Window over one row per label.
    total = F.sum("n_rows").over(W.partitionBy())
    return counts.withColumn("pct", F.bround(F.lit(100.0) * F.col("n_rows") / total, 1))


def negative_volume(
    predictions: DataFrame, now: str, days: int = 14, stages: Sequence[str] = ("Production", "Staging")
) -> DataFrame:
    """Negative predictions per day, a column per stage; days and stages without any are 0."""
    floor = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAY")
    daily = (
        predictions.where(
            F.col("stage").isin(*stages)
            & (F.col("predicted_label") == "negative")
            & (F.col("predicted_at") >= floor)
        )
        .groupBy(F.to_date("predicted_at").alias("period"))
        .pivot("stage", list(stages))
        .agg(F.count(F.lit(1)))
    )
    calendar = daily.agg(F.min("period").alias("a"), F.max("period").alias("b")).where("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b")).alias("period")
    )
    return calendar.join(daily, "period", "left").fillna(0, list(stages))


# ---------- tiles and alerts ----------

def kpi_tiles(df: DataFrame, ts: str = "review_date", threshold: float = ALERT_PERCENT) -> DataFrame:
    """Latest day against the whole window: sizes, label shares, counts, status."""
    newest = df.agg(F.date_trunc("day", F.max(ts))).first()[0]
    if newest is None:
        in_batch = F.lit(True)
    else:
        in_batch = (F.col(ts) >= F.lit(newest)) & (F.col(ts) < F.lit(newest) + F.expr("INTERVAL 1 DAY"))
    counts = df.agg(
        F.count_if(in_batch).alias("batch_size"),
        F.count("*").alias("window_size"),
        *[F.count_if(in_batch & (F.col("label") == lb)).alias(lb) for lb in ("positive", "negative", "neutral")],
    )

    def pct(label: str) -> Column:
        share = F.try_divide(F.lit(100.0) * F.col(label), F.col("batch_size"))
        return F.coalesce(F.bround(share, 1), F.lit(0.0))

    out = counts.select(
        "batch_size",
        "window_size",
        pct("positive").alias("pct_positive"),
        pct("negative").alias("pct_negative"),
        pct("neutral").alias("pct_neutral"),
    )
    size = F.col("batch_size")
    return out.withColumns({
        "n_positive": F.bround(F.col("pct_positive") / 100 * size).cast("long"),
        "n_neutral": F.bround(F.col("pct_neutral") / 100 * size).cast("long"),
        "status": F.when(F.col("pct_negative") >= threshold, "above threshold").otherwise("normal"),
    })


def spike_alert(df: DataFrame, ts: str = "review_date", threshold: float = ALERT_PERCENT) -> DataFrame:
    """Does the latest day's negative share reach the threshold?"""
    batch = latest_batch(df, ts).agg(
        F.count("*").alias("batch_size"), F.coalesce(F.bround(percent_of("negative"), 1), F.lit(0.0)).alias("pct_negative")
    )
    return batch.withColumn("alert", F.col("pct_negative") >= threshold)


def newest_negatives(df: DataFrame, n: int = 4, ts: str = "review_date", ident: str = "review_id") -> DataFrame:
    """The newest negative reviews as cards: snippet, source, date."""
    cards = df.where("label = 'negative'").select(
        F.col(ident),
        text.snippet(F.col("text")).alias("snippet"),
        F.coalesce(F.when(F.col("source") != "", F.initcap("source")), F.lit("Yelp")).alias("source"),
        F.date_format(ts, "dd MMM yyyy").alias("day"),
        F.col(ts).alias("_ts"),
    )
    return cards.orderBy(F.desc("_ts"), ident).limit(n).drop("_ts")


# ---------- words ----------

def negative_word_counts(
    df: DataFrame, top_n: int | None = 50, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """Most frequent words of negative reviews. Pass ``stopwords`` to use another list."""
    drop = sorted(set(REVIEW_STOPWORDS if stopwords is None else stopwords))
    counts = (
        df.where("label = 'negative'")
        .select(F.explode(text.words(F.col("text"))).alias("word"))
        .where(~F.col("word").isin(*drop))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    return counts if top_n is None else counts.orderBy(F.desc("n"), "word").limit(top_n)


# ---------- model comparison ----------

def last_label_per_stage(predictions: DataFrame, by: Column | str = "text") -> DataFrame:
    """The newest label each stage gave a text, one column per stage.

    Aggregates on the text's digest, so a text scored a million times is one row per
    task and no shuffle carries the text itself.
    """
    key = keys.text_digest(F.col(by).cast("string")) if isinstance(by, str) else by

    def newest(stage: str) -> Column:
        label = F.when(F.col("stage") == stage, F.col("predicted_label"))
        when = F.when(F.col("stage") == stage, F.struct("predicted_at", "id"))
        return F.max_by(label, when)

    return predictions.groupBy(key.alias("text_key")).agg(
        newest("Production").alias("production_label"), newest("Staging").alias("staging_label")
    )


def paired_predictions(
    predictions: DataFrame, by: Column | str = "text", now: str | None = None, days: int = 7
) -> DataFrame:
    """Texts both stages have scored, with both labels."""
    if now is not None:
        floor = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAY")
        predictions = predictions.where(F.col("predicted_at") >= floor)
    pairs = last_label_per_stage(predictions, by)
    return pairs.where("production_label IS NOT NULL AND staging_label IS NOT NULL")


def shadow_agreement(pairs: DataFrame) -> DataFrame:
    """How often the stages agree, and each side's label counts."""
    sides = [("production_label", "prod"), ("staging_label", "stag")]
    return pairs.agg(
        F.count("*").alias("n"),
        F.avg(F.when(F.col("production_label") == F.col("staging_label"), F.lit(100.0)).otherwise(F.lit(0.0))).alias(
            "agree_pct"
        ),
        *[
            F.count_if(F.col(column) == lb).alias(f"{short}_{lb}")
            for column, short in sides
            for lb in ("negative", "neutral", "positive")
        ],
    )


# ---------- run history ----------

def drift_history(reports: DataFrame, days: int = 21, report_type: str = "data_drift") -> DataFrame:
    """Newest report of each of the last ``days`` run dates, oldest date first."""
    newest = (
        reports.where(F.col("report_type") == report_type)
        .groupBy("run_date")
        .agg(F.max_by(F.struct("drift_score", "blocked_promotion"), "created_at").alias("r"))
    )
    rows = newest.select(
        "run_date",
        F.coalesce("r.drift_score", F.lit(0.0)).alias("drift_score"),
        F.col("r.blocked_promotion").alias("blocked_promotion"),
    )
    return rows.orderBy(F.desc("run_date")).limit(days).orderBy("run_date")


def latest_report(reports: DataFrame) -> DataFrame:
    return reports.orderBy(F.desc("created_at")).limit(1).select(
        "report_url", "drift_score", "blocked_promotion", "run_date"
    )


def metric_delta(runs: DataFrame, metric: str = "f1_neg", model: str = "model", order: str = "x_ord") -> DataFrame:
    """Change of a metric from the previous to the last run of each model.

    The two newest runs are picked per task before the shuffle; no model's history is
    collected in one place.
    """
    newest_two = (
        runs.withColumn("_rank", F.row_number().over(W.partitionBy(model).orderBy(F.desc(order))))
        .where("_rank <= 2")
        .groupBy(model)
        .agg(
            F.max(F.when(F.col("_rank") == 1, F.col(metric))).alias("last"),
            F.max(F.when(F.col("_rank") == 2, F.col(metric))).alias("previous"),
            F.count("*").alias("_n"),
        )
    )
    return newest_two.where("_n = 2").select(
        model, "last", "previous", (F.col("last") - F.col("previous")).alias("delta")
    )


def leaderboard(versions: DataFrame) -> DataFrame:
    """Model versions, one per run: best stage first, then highest version.

    ``versions`` has ``run_id, version, stage`` and one or more metric spellings.
    """
    stage = F.lower(F.coalesce("stage", F.lit("none")))
    status = F.when(stage == "none", "archived").otherwise(stage)
    order = F.lit(9)
    for name, position in STAGE_ORDER.items():
        order = F.when(F.col("status") == name, position).otherwise(order)
    ranked = versions.withColumn("status", status).withColumn("stage_order", order)
    first = F.row_number().over(W.partitionBy("run_id").orderBy("stage_order", F.desc("version")))
    return ranked.withColumn("_rank", first).where("_rank = 1").drop("_rank")


def metric_alias(df: DataFrame, name: str, *spellings: str) -> DataFrame:
    """One column from the first spelling of a metric that has a value."""
    present = [c for c in (name, *spellings) if c in df.columns]
    value = F.coalesce(*[F.col(c).cast("double") for c in present]) if present else F.lit(None).cast("double")
    return df.withColumn(name, value)


def run_summary(silver: DataFrame, touched: Sequence[str], key: str = "review_date") -> DataFrame:
    """Rows per touched partition, and their total under the key ``total``."""
    counts = silver.where(F.col(key).isin(*touched)).groupBy(key).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.lit("total").alias(key), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return counts.unionByName(total)
