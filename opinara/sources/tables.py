"""Keyed tables kept as Parquet: merge, append, replace, and their constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import dates, text
from opinara.operators import gold, quality
from opinara.operators.refine import latest_per_key, soft_clean
from opinara.schemas import (
    DERIVED_LABEL_SOURCE,
    LABELS,
    NULL_KEY,
    REVIEWS,
    REVIEWS_GOLD,
    REVIEWS_SILVER,
    SILVER_RENAMES,
)
from opinara.session import shuffles_removed, stage, staged
from opinara.sources import files, key_index


def nulls_for_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project onto ``columns`` (absent ones null) with NaN turned into null."""
    types = dict(df.dtypes)

    def value(c: str):
        if c not in types:
            return F.lit(None).cast("string")
        return text.no_nan(F.col(c)) if types[c] in ("double", "float") else F.col(c)

    return df.select(*[value(c).alias(c) for c in columns])


def as_reviews_silver(silver: DataFrame) -> DataFrame:
    """Silver columns under their warehouse names."""
    if "review_date" in silver.columns:
        silver = silver.drop("review_date")
    return silver.withColumnsRenamed(SILVER_RENAMES)


def merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` (unique by key) replace those of ``target``, others stay.

    The target is only tested for membership, so its rows are not shuffled when Spark
    can broadcast the incoming keys.
    """
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(incoming.select(*target.columns))


def silver_table_rows(silver: DataFrame) -> DataFrame:
    """Silver rows as ``reviews_silver`` wants them, one per (source, source_id)."""
    rows = nulls_for_nan(as_reviews_silver(silver), REVIEWS_SILVER)
    return latest_per_key(rows, ["source", "source_id"], "ingested_at")


def gold_table_rows(rows: DataFrame, built_at: str) -> DataFrame:
    """Gold rows as ``reviews_gold`` wants them, one per review; the time is an argument."""
    if "label_source" not in rows.columns:
        rows = rows.withColumn("label_source", F.lit(DERIVED_LABEL_SOURCE))
    if "text_len" not in rows.columns:
        rows = rows.withColumn("text_len", text.text_length(F.col("text")))
    stamped = rows.withColumn("built_at", F.lit(built_at).cast("timestamp")).select(*REVIEWS_GOLD)
    return latest_per_key(stamped, ["review_id"], "review_date")


def upsert_silver(target: DataFrame, silver: DataFrame) -> DataFrame:
    """Merge Silver rows into ``reviews_silver`` on (source, source_id)."""
    return merge(target.select(*REVIEWS_SILVER), silver_table_rows(silver), ["source", "source_id"])


def upsert_gold(target: DataFrame, incoming: DataFrame, built_at: str) -> DataFrame:
    """Merge Gold rows into ``reviews_gold`` on review_id."""
    return merge(target.select(*REVIEWS_GOLD), gold_table_rows(incoming, built_at), ["review_id"])


def storable(scored: DataFrame, max_chars: int = 10_000) -> DataFrame:
    """Blank texts are left out, long ones cut to the column's size."""
    return scored.where(text.not_blank(F.col("text"))).withColumn("text", F.substring("text", 1, max_chars))


def append_scored(reviews: DataFrame, scored: DataFrame) -> DataFrame:
    """Add scored rows to the reviews."""
    return reviews.unionByName(storable(scored).select(*reviews.columns))


def replace_recent(reviews: DataFrame, fresh: DataFrame, now: str, days: int = 1) -> DataFrame:
    """Drop the last ``days`` before ``now``, then add the fresh rows."""
    floor = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAY")
    older = F.coalesce(F.col("ingested_at") < floor, F.lit(True))  # undated rows are not recent
    return reviews.where(older).unionByName(fresh.select(*reviews.columns))


def append_report(
    reports: DataFrame, run_date: str, report_type: str, url: str, score: float | None, blocked: bool,
    created_at: str,
) -> DataFrame:
    """Add one monitoring report row."""
    row = reports.sparkSession.createDataFrame(
        [(run_date, report_type, url, score, blocked)],
        "run_date string, report_type string, report_url string, drift_score double, blocked_promotion boolean",
    ).withColumn("created_at", F.lit(created_at).cast("timestamp"))
    return reports.unionByName(row.select(*reports.columns))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


# ---------- tables on disk ----------

def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; one that does not exist yet is empty."""
    df = files.load_if_present(spark.read.schema(schema).parquet, path)
    return spark.createDataFrame([], schema) if df is None else df


def replace_table(df: DataFrame, path: str) -> int:
    """Truncate and load. The new rows are staged first, for they may come from ``path``."""
    ready = stage(df, "load")
    ready.write.mode("overwrite").parquet(path)
    return ready.count()


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


REVIEWS_BY_DAY = T.StructType(REVIEWS.fields + [T.StructField("day", T.StringType())])


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The scored reviews, kept by the day of ``ingested_at``."""
    return files.read_partitions(spark, path, REVIEWS_BY_DAY, key="day").drop("day")


def store_reviews(
    spark: SparkSession, path: str, fresh: DataFrame, now: str, clear_days: int = 0, truncate: bool = False
) -> int:
    """Add rows to the stored reviews, after dropping the last ``clear_days`` (or all).

    Only days that lose or receive rows are read and rewritten. Undated rows live in a
    partition of their own and are never recent. Returns rows added.
    """
    day = dates.partition_key(dates.iso(F.col("ingested_at")))
    rows = stage(storable(fresh).select(*REVIEWS.fieldNames(), day.alias("day")), "reviews")
    if truncate:
        rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        return rows.count()
    table = files.read_partitions(spark, path, REVIEWS_BY_DAY, key="day")
    # Distinct calendar days.
    receiving = [r[0] for r in rows.select("day").distinct().collect()]
    floor = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(clear_days)} DAY")
    losing = (F.col("day") >= dates.iso(floor)) & (F.col("day") != NULL_KEY) if clear_days else F.lit(False)
    touched = table.where(losing | F.col("day").isin(*receiving))
    staying = touched.where(F.coalesce(F.col("ingested_at") < floor, F.lit(True))) if clear_days else touched
    emptied = set()
    if clear_days:
        before, after = (
            {r[0] for r in df.select("day").distinct().collect()} for df in (touched, staying)
        )
        emptied = before - after - set(receiving)
    files.write_partitions(staying.unionByName(rows), path, "day")
    files.drop_partitions(spark, path, sorted(emptied), "day")
    return rows.count()


def load_reviews_table(frame: DataFrame, path: str, gate) -> int:
    """Clean rows that passed ``gate`` replace the reviews table; returns how many."""
    clean = soft_clean(frame)
    gate(clean).raise_for_status()
    return replace_table(clean, path)


def load_passing(frame: DataFrame, path: str, rejects: str) -> tuple[int, int]:
    """Clean rows that keep every row rule of the training contract replace the table at ``path``.

    The others replace the one at ``rejects``, whole, with ``faults``: the rules each
    breaks. Returns how many rows went where; no row is cut or lost.
    """
    clean = soft_clean(frame)
    judged = stage(clean.withColumn("faults", quality.training_faults(clean.columns)), "judged")
    passes = F.size("faults") == 0
    return replace_table(judged.where(passes).drop("faults"), path), replace_table(judged.where(~passes), rejects)


def _dated(df: DataFrame) -> DataFrame:
    """With ``day``, the calendar day of the raw review date, which tables are kept by.

    Undated rows are stored under the null key.
    """
    dated = df.withColumn("review_date", F.coalesce("review_date", F.lit(NULL_KEY)))
    return dated.withColumn("day", dates.review_date_key(F.col("review_date")))


def read_merged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that ``merge_table`` keeps, in its own columns."""
    stored = T.StructType([*[f for f in schema.fields if f.name != "day"], T.StructField("day", T.StringType())])
    return files.read_partitions(spark, path, stored, key="day").drop("day")


def merge_table(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], slices: int = 1) -> int:
    """Merge rows into a stored table kept by the day of ``review_date``; returns rows merged.

    ``review_date`` may be a full time stamp and is stored as it is. Only the days that
    receive rows, and those where a row is replaced (a review may have moved to another
    day), are rewritten, as many at a time as ``in_parts`` says; the index of keys by day
    (``key_index``) tells which days can be of the latter, and no other is opened. Days that
    were stored without an index get one. ``incoming`` is evaluated for one of ``slices`` of
    its keys after the other, so that no more than that is shuffled at once.
    """
    number = F.pmod(F.xxhash64(*keys), F.lit(slices))
    with shuffles_removed(spark):
        dated = _dated(incoming)
        parts = [dated.where(number == i) for i in range(slices)] if slices > 1 else [dated]
        with staged(parts[0], "merge", *parts[1:]) as fresh:
            return _merge_staged(spark, path, fresh, keys)


def _merge_staged(spark: SparkSession, path: str, fresh: DataFrame, keys: Sequence[str]) -> int:
    n_rows = fresh.count()
    table = files.read_partitions(spark, path, fresh.schema, key="day")
    narrow = table.select(*keys, "day")
    ids = fresh.select(*keys)
    # Distinct calendar days.
    receiving = {r[0] for r in fresh.select("day").distinct().collect()}
    stored = set(files.partition_keys(spark, path, "day"))
    unknown = stored - key_index.indexed_days(spark, path, keys)
    if unknown:
        key_index.index_days(narrow.where(F.col("day").isin(*unknown)), path, keys)
    candidates = (key_index.days_holding(spark, path, ids, keys, receiving) & stored) - receiving
    maybe = narrow.where(F.col("day").isin(*candidates))
    losing = {r[0] for r in maybe.join(ids, list(keys), "left_semi").select("day").distinct().collect()} if candidates else set()
    left = narrow.where(F.col("day").isin(*losing)).join(ids, list(keys), "left_anti") if losing else None
    emptied = losing - {r[0] for r in left.select("day").distinct().collect()} if losing else set()
    touched = table.where(F.col("day").isin(*(receiving | losing)))
    # Keys are in the index before their rows are in the table.
    key_index.index_days(narrow.where(F.col("day").isin(*receiving)).unionByName(fresh.select(*keys, "day")), path, keys)
    sized = ["day", "text_len"] if "text_len" in fresh.columns else ["day"]
    for days in files.in_parts(touched.select(*sized).unionByName(fresh.select(*sized)), "day"):
        part = fresh.where(F.col("day").isin(*days))
        if stored.intersection(days):
            kept = table.where(F.col("day").isin(*days)).join(ids, list(keys), "left_anti").select(*table.columns)
            part = kept.unionByName(part.select(*table.columns))
        files.write_partitions(part, path, "day")
    files.drop_partitions(spark, path, sorted(emptied), "day")
    if losing:
        spark.catalog.refreshByPath(path)
        now = files.read_partitions(spark, path, fresh.schema, key="day").select(*keys, "day")
        key_index.index_days(now.where(F.col("day").isin(*(losing - emptied))), path, keys, emptied)
    return n_rows


def publish(
    spark: SparkSession, silver_root: str, gold_root: str, warehouse: str, keys: Sequence[str] | None,
    built_at: str,
) -> DataFrame:
    """Merge the touched partitions into both warehouse tables; rows written per table."""
    with shuffles_removed(spark):
        silver = files.read_silver(spark, silver_root, keys)
        features, labels = files.read_gold(spark, gold_root, keys)
        slices = max(1, len(list(files.in_parts(silver))))
        written = [
            ("reviews_silver", merge_table(
                spark, f"{warehouse}/reviews_silver", silver_table_rows(silver), ["source", "source_id"], slices
            )),
            ("reviews_gold", merge_table(
                spark, f"{warehouse}/reviews_gold", gold_table_rows(gold.gold_rows(features, labels), built_at),
                ["review_id"], slices,
            )),
        ]
    return spark.createDataFrame(written, "table string, rows_written long")


# ---------- constraints ----------

def constraint_violations(
    df: DataFrame, key: Sequence[str], not_null: Sequence[str], label: str | None = None
) -> DataFrame:
    """Rows breaking the primary key, each NOT NULL column and the label check."""
    extra = df.groupBy(*key).count().agg(
        F.lit("primary_key").alias("rule"),
        F.lit(",".join(key)).alias("column"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_violations"),
    )
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    if label:
        checks.append(("check", label, ~F.col(label).isin(*LABELS)))
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(f"c{i}").alias("n_violations"))
        for i, (rule, c, _) in enumerate(checks)
    ]))
    return extra.unionByName(counts.select(rows))
