"""Table contracts and the helpers that hold frames to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition key of undated rows, label enum, accepted sources.
NULL_KEY = "__null__"
LABELS = ["negative", "neutral", "positive"]
VALID_SOURCES = ["yelp", "malaysia", "replay", "google", "tripadvisor"]
JOINED_SOURCE = "yelp"
FLAT_SOURCE = "tripadvisor"
DERIVED_LABEL_SOURCE = "derived_from_rating"

_s, _d, _l, _t = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _strings(*names: str) -> T.StructType:
    return _struct(*((n, _s) for n in names))


# Bronze keeps source values verbatim, so every column is a string.
REVIEW_FIELDS = _strings(
    "review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date"
)
BUSINESS_FIELDS = _strings(
    "business_id", "name", "address", "city", "state", "postal_code", "stars", "review_count", "categories"
)
FLAT_FIELDS = _strings("Author", "Title", "Review", "Rating", "Dates", "Restaurant", "Location")
PROVENANCE = _strings("_source", "_ingested_at")

SILVER = _struct(
    ("text", _s),
    ("text_len", T.IntegerType()),
    ("rating", _d),
    ("source", _s),
    ("source_id", _s),
    ("restaurant", _s),
    ("location", _s),
    ("date", _s),
    ("_ingested_at", _s),
)
SILVER_CONTRACT = [f.name for f in SILVER if f.name != "_ingested_at"]
SILVER_PARTITIONED = T.StructType(SILVER.fields + [T.StructField("review_date", _s)])

FEATURE_STORE = _strings("review_id", "text", "review_date")
LABEL_STORE = _strings("review_id", "label", "review_date")
TRAINING_CONTRACT = ["text", "label", "rating", "source", "restaurant", "location"]
GOLD_CONTRACT = [*TRAINING_CONTRACT, "date"]
TRAINING_FRAME = ["text", "label", "review_date"]
REPLAY_COLUMNS = ["review_id", "review_date", "text", "label", "source", "scenario", "brand"]

# Warehouse tables.
SILVER_RENAMES = {"date": "review_date", "_ingested_at": "ingested_at"}
REVIEWS_SILVER = [
    "source", "source_id", "text", "text_len", "rating", "restaurant", "location", "review_date", "ingested_at"
]
REVIEWS_GOLD = ["review_id", "review_date", "text", "label", "label_source", "text_len", "built_at"]
REVIEWS = _struct(("text", _s), ("label", _s), ("source", _s), ("ingested_at", _t))
PREDICTIONS = _struct(
    ("id", _l), ("review_id", _s), ("text", _s), ("predicted_label", _s), ("model_name", _s),
    ("model_version", _s), ("stage", _s), ("predicted_at", _t),
)
MONITORING_REPORTS = _struct(
    ("run_date", _s), ("report_type", _s), ("report_url", _s), ("drift_score", _d),
    ("blocked_promotion", T.BooleanType()), ("created_at", _t),
)
HUMAN_CORRECTIONS = _struct(
    ("id", _l), ("review_id", _s), ("corrected_label", _s), ("corrected_by", _s), ("corrected_at", _t)
)


def require(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """Raise ``ValueError`` when ``df`` lacks a required column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``; columns it lacks become typed nulls."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def schema_diff(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per column of either side: ``present``, ``missing`` or ``extra``, and how
    many rows have a value there."""
    status = {c: "present" if c in df.columns else "missing" for c in expected}
    status.update({c: "extra" for c in df.columns if c not in expected})
    counts = df.agg(*[
        (F.count(f"`{c}`") if c in df.columns else F.lit(0).cast("long")).alias(f"n{i}")
        for i, c in enumerate(status)
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), F.col(f"n{i}").alias("n_values"))
        for i, (c, s) in enumerate(status.items())
    ])))


def shared_columns(left: DataFrame, right: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    """Columns both frames have, in the order of ``among`` (or of ``left``)."""
    return [c for c in (among or left.columns) if c in left.columns and c in right.columns]
