"""Replay: shape a labelled window into a stream and land it by event date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.keys import review_key
from opinara.plans.bounded import spread_sort
from opinara.schemas import REPLAY_COLUMNS, require
from opinara.sources import files


def replay_rows(df: DataFrame, scenario: str, brand: str, ordered: bool = True) -> DataFrame:
    """Add a stable id and the source, scenario and brand tags; in time order."""
    require(df, ["text", "label", "review_date"], "replay input")
    day, body = F.col("review_date").cast("string"), F.col("text").cast("string")
    rows = df.withColumns({
        "review_date": day,
        "text": body,
        "review_id": review_key(F.lit(scenario), day, body),
        "source": F.lit("replay"),
        "scenario": F.lit(scenario),
        "brand": F.lit(brand),
    }).select(*REPLAY_COLUMNS)
    return spread_sort(rows, "review_date", "review_id") if ordered else rows


def emit(rows: DataFrame, root: str) -> int:
    """Write the stream, one directory per event date; how many dates there are."""
    files.write_partitions(rows, root)
    return rows.select("review_date").distinct().count()
