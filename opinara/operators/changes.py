"""Change points of a daily series: cumulative sums instead of a fixed line.

The upper sum adds up how far each day lies above the mean of a baseline, less an
allowance, and starts again whenever it would fall below zero. It is a prefix sum less
its running minimum, so windows compute it. The lower sum is the same below the mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# In standard deviations of the baseline: what a day may lie off, and the sum that is a change.
ALLOWANCE = 0.5
DECISION = 5.0


def daily_share(df: DataFrame, label: str = "negative", by: Sequence[str] = (), day: str = "review_date") -> DataFrame:
    """``by``, day, n_rows and ``share``: percent of labelled rows with ``label``."""
    rows = df.where(F.col("label").isNotNull() & F.col(day).isNotNull())
    share = F.count_if(F.col("label") == label) * F.lit(100.0) / F.count("*")
    return rows.groupBy(*by, F.col(day).alias("day")).agg(F.count("*").alias("n_rows"), share.alias("share"))


def change_points(
    series: DataFrame, baseline: int, value: str = "share", by: Sequence[str] = (), allowance: float = ALLOWANCE, decision: float = DECISION,
) -> DataFrame:
    """Every day with ``upper`` and ``lower`` sums in standard deviations, ``change`` and ``since``.

    The first ``baseline`` days of each series give its mean and deviation; a series that
    does not vary there is measured in its own units. ``change`` is up, down or null;
    ``since`` is the first day of the sum that stands, null where it is zero. A series is
    a row per day, so a window over it is bounded by the calendar, whatever the reviews.
    """
    own = Window.partitionBy(*by)
    order = own.orderBy("day")
    placed = series.where(F.col(value).isNotNull()).withColumn("_k", F.row_number().over(order))
    first = F.when(F.col("_k") <= baseline, F.col(value))
    spread = F.stddev_pop(first).over(own)
    scaled = placed.withColumn(
        "_z", (F.col(value) - F.avg(first).over(own)) / F.when(spread > 0, spread).otherwise(F.lit(1.0))
    )
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    out = scaled
    for name, step in (("upper", F.col("_z") - allowance), ("lower", -F.col("_z") - allowance)):
        out = out.withColumn(f"_{name}", F.sum(step).over(upto))
        # The sum starts from zero, which is a minimum as well.
        out = out.withColumn(name, F.col(f"_{name}") - F.least(F.lit(0.0), F.min(f"_{name}").over(upto)))
    change = F.when(F.col("upper") >= decision, "up").when(F.col("lower") >= decision, "down")
    standing = F.when(F.col("change") == "down", F.col("lower")).otherwise(F.col("upper"))
    marked = out.withColumn("change", change).withColumn("_standing", standing)
    zero_up = F.max(F.when(F.col("upper") <= 0, F.col("_k"))).over(upto)
    zero_down = F.max(F.when(F.col("lower") <= 0, F.col("_k"))).over(upto)
    start = F.coalesce(F.when(F.col("change") == "down", zero_down).otherwise(zero_up), F.lit(0)) + 1
    days = F.collect_list("day").over(upto)
    since = F.when(F.col("_standing") > 0, F.element_at(days, start.cast("int")))
    kept = [*by, "day", *(c for c in series.columns if c not in (*by, "day"))]
    return marked.select(*kept, "upper", "lower", "change", since.alias("since"))
