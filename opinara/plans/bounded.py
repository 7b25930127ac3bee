"""Small values, ranks and sorts whose driver- or task-side state has a checked bound."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from opinara.functions.keys import ORDER_DIGITS
from opinara.session import stage

# Most rows of an aggregate that are taken to the driver, and handed to every task.
SMALL_ROWS = 10_000


def values_or_none(df: DataFrame, max_rows: int = SMALL_ROWS) -> list | None:
    """The rows of a small table, or None when it has more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def spread_sort(df: DataFrame, *columns: str) -> DataFrame:
    """Total order by ``columns``; equal rows may come in any order.

    The random last key lets Spark cut a run of equal values into several tasks.
    """
    return df.orderBy(*columns, F.rand(0))


def rank_cutoffs(
    df: DataFrame, group: str, order: str, ranks: DataFrame, step: int = 3, small: int = 1_000_000
) -> DataFrame:
    """Per group, the ``order`` values of the rows at the wanted 1-based ranks.

    ``ranks`` has (g, i, k): a group as text, the number of the rank and the rank; the
    result has (g, i, h), without ranks of 0. ``order`` is a hex string spread evenly
    (``seeded_order``). No group is sorted: rows are counted by their next ``step`` digits
    (16^step values, so tasks send few rows), which finds the bucket each rank falls in;
    the next pass looks inside those buckets only. Once all have at most ``small`` rows
    their full values are counted instead. Equal values collapse to one counted row
    before any shuffle. Groups may be many: they are joined, never taken to the driver.
    """
    keyed = df.select(F.col(group).cast("string").alias("g"), F.col(order).alias("h"))
    found = ranks.where("k > 0").select("g", "i", F.lit("").alias("b"), F.col("k").cast("long").alias("rest"))
    found = stage(found, "ranks")
    depth, last = 0, False
    while True:
        buckets = found.select(F.col("g").alias("g0"), F.col("b").alias("b0")).distinct()
        inside = keyed.join(buckets, F.equal_null("g", "g0") & (F.substring("h", 1, depth) == F.col("b0")))
        value = F.col("h") if last else F.substring("h", 1, depth + step)
        counts = inside.groupBy("g", "b0", value.alias("next")).agg(F.count("*").alias("n"))
        wanted = found.select(F.col("g").alias("g1"), "i", "b", "rest")
        # Window over counts, not over rows.
        upto = F.sum("n").over(W.partitionBy("g", "i").orderBy("next"))
        hits = (
            counts.join(wanted, F.equal_null("g", "g1") & (F.col("b0") == F.col("b")))
            .withColumn("upto", upto)
            .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
            .select("g", "i", F.col("next").alias("b"), "n", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest"))
        )
        found = stage(hits, "ranks")
        most = found.agg(F.max("n")).first()[0]
        if last or most is None:
            return found.select("g", "i", F.col("b").alias("h"))
        depth += step
        last = most <= small or depth >= ORDER_DIGITS


def nth_newest(df: DataFrame, ts: str, n: int):
    """Timestamp of the ``n``-th newest row (1-based), by narrowing counts.

    Day, then second, then microsecond: every step counts in parallel and looks only
    at the unit the previous step found, so no step sorts rows.
    """
    rows = df.select(F.col(ts).alias("t")).where("t IS NOT NULL")
    for unit in ("day", "second", "microsecond"):
        counts = rows.groupBy(F.date_trunc(unit, "t").alias("u")).agg(F.count("*").alias("n"))
        # At most one row per calendar day, second of a day, or microsecond of a second.
        newer = F.sum("n").over(W.orderBy(F.desc("u")))
        hit = (
            counts.withColumn("newer", newer)
            .where((F.col("newer") >= n) & (F.col("newer") - F.col("n") < n))
            .select("u", (F.lit(n) - F.col("newer") + F.col("n")).alias("rest"))
            .first()
        )
        if unit == "microsecond":
            return hit.u
        n = hit.rest
        step = F.expr(f"INTERVAL 1 {unit}")
        rows = rows.where((F.col("t") >= F.lit(hit.u)) & (F.col("t") < F.lit(hit.u) + step))
