"""File sources and sinks: JSON lines, CSV, partitioned Parquet."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import dates, text
from opinara.operators.refine import names_in_scope, stamp
from opinara.schemas import (
    BUSINESS_FIELDS,
    FEATURE_STORE,
    FLAT_FIELDS,
    FLAT_SOURCE,
    JOINED_SOURCE,
    LABEL_STORE,
    NULL_KEY,
    REVIEW_FIELDS,
    SILVER,
    SILVER_PARTITIONED,
    conform,
)
from opinara.session import remove_path
from opinara.sources.split_csv import read_split_csv

# Quotes doubled, newlines inside quotes: what spreadsheet tools and pandas write.
CSV_READ = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
CSV_WRITE = {
    "header": "true", "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    # A multi-line file is read by one task, so files are kept small.
    "maxRecordsPerFile": "200000",
}
# What a merge shuffles is on disk besides the table, so large ones go in parts: at most
# about so many, of so many bytes of rows at least. A row counts as its text and ROW_BYTES.
MOST_PARTS = 8
PART_BYTES = 512_000_000
ROW_BYTES = 200


def load_if_present(reader, path) -> DataFrame | None:
    """The frame at ``path``, or None when nothing is there."""
    try:
        return reader(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_json_records(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One object per line; blank and broken lines are skipped, missing fields are null."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_flat_csv(
    spark: SparkSession,
    path: str,
    ingested_at: str,
    in_scope_only: bool = True,
    keywords: Sequence[str] | None = None,
    limit: int | None = None,
    source: str = FLAT_SOURCE,
    split: bool = False,
) -> DataFrame:
    """Raw review CSV to stamped Bronze: values as they are, absent columns null.

    Columns are matched by header name, so the file may hold more, fewer or reordered
    ones. A cap takes the first rows in (restaurant, author, title) order. A file is read
    by one task, or, with ``split``, by as many as it has splits.
    """
    raw = read_split_csv(spark, path, CSV_READ) if split else spark.read.options(**CSV_READ).csv(path)
    shaped = conform(raw, FLAT_FIELDS)
    shaped = shaped.select(*[text.missing_to_null(F.col(c)).alias(c) for c in shaped.columns])
    if in_scope_only or keywords:
        shaped = names_in_scope(shaped, "Restaurant", keywords)
    if limit is not None:
        shaped = shaped.orderBy("Restaurant", "Author", "Title", "Dates", "Review").limit(limit)
    return stamp(shaped, source, ingested_at)


def read_many(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Several Parquet tables as one, only the wanted columns read."""
    return spark.read.parquet(*paths).select(*columns)


# ---------- partitioned tables ----------

def write_partitions(df: DataFrame, root: str, key: str = "review_date", fmt: str = "parquet", **options) -> None:
    """Replace exactly the partitions ``df`` holds; the others stay.

    The rebalance hint sizes the files at run time: small keys share a task, a key with
    very many rows is spread over several.
    """
    (
        df.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**({"compression": "zstd"} | options))
        .partitionBy(key)
        .format(fmt)
        .save(root)
    )


def in_parts(df: DataFrame, key: str = "review_date") -> Iterator[list[str]]:
    """The keys of ``df`` in order, in runs of keys that hold ``PART_BYTES`` of rows or an equal share of them."""
    length = F.coalesce("text_len", F.lit(0)) if "text_len" in df.columns else F.lit(0)
    # One row per calendar day.
    sizes = df.groupBy(key).agg(F.sum(length + F.lit(ROW_BYTES).cast("long"))).collect()
    part, held, most = [], 0, max(PART_BYTES, sum(r[1] for r in sizes) / MOST_PARTS)
    for value, size in sorted(map(tuple, sizes)):
        if part and held + size > most:
            yield part
            part, held = [], 0
        part.append(value)
        held += size
    if part:
        yield part


def drop_partitions(spark: SparkSession, root: str, keys: Sequence[str], key: str = "review_date") -> None:
    """Remove whole partitions, on whatever file system ``root`` is."""
    for value in keys:
        remove_path(spark, f"{root}/{key}={value}")


def partition_keys(spark: SparkSession, root: str, key: str = "review_date") -> list[str]:
    """The stored partitions under ``root`` by their directories; no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [f.getPath().getName() for f in system.listStatus(path) if f.isDirectory()]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(unescape(n.removeprefix(f"{key}=")) for n in names if n.startswith(f"{key}="))


def read_partitions(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str] | None = None,
    key: str = "review_date",
) -> DataFrame:
    """Partitions under ``root`` in the table's schema; columns old files lack are null.

    An absent table reads as empty. ``keys`` prunes directories.
    """
    df = load_if_present(spark.read.schema(schema).parquet, root)
    if df is None:
        df = spark.createDataFrame([], schema)
    return df if keys is None else df.where(F.col(key).isin(*keys))


# ---------- Bronze ----------

def bronze_path(root: str, source: str, table: str) -> str:
    return f"{root}/{source}/{table}"


def write_bronze(df: DataFrame, root: str, source: str, table: str, ingestion_date: str) -> None:
    """Land one ingestion date of a Bronze table as CSV under ``dt=``; a re-run replaces it.

    Files are compressed: multi-line files are read by one task each anyway.
    """
    dated = df.withColumn("dt", F.lit(ingestion_date))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV_WRITE, compression="gzip")
        .partitionBy("dt")
        .csv(bronze_path(root, source, table))
    )


def read_bronze(
    spark: SparkSession, root: str, source: str, table: str, ingestion_dates: Sequence[str]
) -> DataFrame | None:
    """A Bronze table's rows of the given dates, everything a string.

    A date that was never landed falls back to the undated file ``<table>.csv`` (read
    once). None when neither exists.
    """
    fields = {"reviews": FLAT_FIELDS if source == FLAT_SOURCE else REVIEW_FIELDS, "business": BUSINESS_FIELDS}
    if source not in (FLAT_SOURCE, JOINED_SOURCE):
        raise ValueError(f"unknown source: {source}")
    columns = T.StructType(
        fields[table].fields
        + [T.StructField("_source", T.StringType()), T.StructField("_ingested_at", T.StringType())]
    )
    path = bronze_path(root, source, table)
    reader = spark.read.options(**CSV_READ)
    # Each landing by its own header: columns may have come or gone between dates.
    landed = [load_if_present(reader.csv, f"{path}/dt={d}") for d in ingestion_dates]
    parts = [df for df in landed if df is not None]
    if len(parts) < len(landed):
        flat = load_if_present(reader.csv, f"{path}.csv")
        if flat is not None:
            parts.append(flat)
    if not parts:
        return None
    merged = conform(parts[0], columns)
    for part in parts[1:]:
        merged = merged.unionByName(conform(part, columns))
    return merged.select(*[text.missing_to_null(F.col(c)).alias(c) for c in merged.columns])


# ---------- Silver and Gold ----------

def read_silver(spark: SparkSession, root: str, keys: Sequence[str] | None = None) -> DataFrame:
    return read_partitions(spark, root, SILVER_PARTITIONED, keys)


def write_silver(df: DataFrame, root: str) -> None:
    """Silver in its fixed column order, one directory per event date."""
    keyed = df if "review_date" in df.columns else df.withColumn(
        "review_date", dates.review_date_key(F.col("date"))
    )
    write_partitions(conform(keyed, SILVER_PARTITIONED), root)


def read_gold(spark: SparkSession, root: str, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    return (
        read_partitions(spark, f"{root}/feature_store", FEATURE_STORE, keys),
        read_partitions(spark, f"{root}/label_store", LABEL_STORE, keys),
    )


def write_gold(features: DataFrame, labels: DataFrame, root: str) -> None:
    """Both stores, every date of the frames in one write each."""
    for name, df, schema in (
        ("feature_store", features, FEATURE_STORE),
        ("label_store", labels, LABEL_STORE),
    ):
        keyed = df.withColumn("review_date", F.coalesce("review_date", F.lit(NULL_KEY)))
        write_partitions(conform(keyed, schema), f"{root}/{name}")


def write_training_csv(frame: DataFrame, path: str) -> str:
    frame.write.mode("overwrite").options(**CSV_WRITE).csv(path)
    return path


def empty_silver(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SILVER)
