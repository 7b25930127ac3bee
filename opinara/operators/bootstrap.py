"""How sure a gate can be: Poisson bootstrap of classification metrics in one pass.

In each replicate a row counts a Poisson(1) number of times, read off a hash of its key,
so that replicates are drawn without sampling, are the same wherever and however often a
row is read, and add up like any count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators.drift import F1_DROP, RECALL_NEG_DROP

REPLICATES = 64
#: Replicates that one digest of 64 hex digits serves, four digits each.
_PER_DIGEST = 16
_LEVELS = 1 << 16


def poisson_cuts() -> list[int]:
    """A row counts k times if its 16 bits lie below k of these levels' complements."""
    total, cuts = 0.0, []
    for k in range(9):
        total += math.exp(-1) / math.factorial(k)
        cuts.append(round(total * _LEVELS))
    return [c for c in cuts if c < _LEVELS]


def weighted(df: DataFrame, key: Column, replicates: int = REPLICATES, seed: int = 42) -> DataFrame:
    """``df`` with ``replicate`` and ``weight``: a row for each replicate that a row counts in.

    Digests are exploded before their digits, so each is computed once for its replicates.
    """
    digests = F.explode(F.array(*[
        F.struct(F.lit(block).alias("block"), F.sha2(F.concat(F.lit(f"{seed}|{block}|"), key.cast("string")), 256).alias("digest"))
        for block in range(-(-replicates // _PER_DIGEST))
    ]))
    places = F.explode(F.sequence(F.lit(0), F.lit(_PER_DIGEST - 1)))
    spread = df.select("*", digests.alias("_d")).select("*", places.alias("_at"))
    bits = F.conv(F.substr(F.col("_d.digest"), F.col("_at") * 4 + 1, F.lit(4)), 16, 10).cast("int")
    marked = spread.select(
        *df.columns, (F.col("_d.block") * _PER_DIGEST + F.col("_at")).alias("replicate"), bits.alias("_bits")
    ).where(F.col("replicate") < replicates)
    weight = sum(((F.col("_bits") >= c).cast("int") for c in poisson_cuts()), F.lit(0))
    return marked.withColumn("weight", weight).where("weight > 0").drop("_bits")


def replicate_metrics(
    df: DataFrame, key: str, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction",
    replicates: int = REPLICATES, seed: int = 42,
) -> DataFrame:
    """``by``, replicate, f1_macro, recall_neg: as ``metrics.summary``, with rows weighted.

    A row makes one per replicate it counts in, summed up before the one shuffle to a row
    per task, replicate, label and prediction. Rows without label or prediction are left out.
    """
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).select(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
    )
    rows = weighted(known, F.col("_key"), replicates, seed)
    group = [*by, "replicate"]
    counts = rows.groupBy(*group, "label", "prediction").agg(F.sum("weight").alias("n"))
    sides = counts.select(*group, F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )))
    per_class = sides.groupBy(*group, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    f1 = F.col("tp") * 2 / (F.col("support") + F.col("predicted"))
    recall = F.try_divide(F.col("tp"), F.col("support"))
    return per_class.groupBy(*group).agg(
        F.avg(f1).alias("f1_macro"), F.max(F.when(F.col("class") == "negative", recall)).alias("recall_neg")
    )


def _rank(of: Column, share: float) -> Column:
    """The value at a share of the sorted array ``of``."""
    return F.element_at(of, F.greatest(F.ceil(F.size(of) * F.lit(share)), F.lit(1)).cast("int"))


def interval(replicates: DataFrame, columns: Sequence[str], by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """``by``, metric, low, middle, high: the quantiles of the replicates, which are few."""
    long = replicates.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]))).where("value IS NOT NULL")
    values = F.sort_array(F.collect_list("value"))
    edge = (1 - level) / 2
    return long.groupBy(*by, "metric").agg(values.alias("_all")).select(
        *by, "metric", _rank(F.col("_all"), edge).alias("low"), _rank(F.col("_all"), 0.5).alias("middle"), _rank(F.col("_all"), 1 - edge).alias("high")
    )


def gate_interval(
    reference: DataFrame, current: DataFrame, key: str, f1_drop: float = F1_DROP, recall_neg_drop: float = RECALL_NEG_DROP,
    level: float = 0.95, replicates: int = REPLICATES, seed: int = 42,
) -> DataFrame:
    """``metric, low, middle, high, limit, verdict`` of the drops that the promotion gate looks at.

    ``blocked`` if the whole interval lies above the limit, ``passed`` if none of it does,
    else ``unsure``.
    """
    sides = [
        replicate_metrics(df, key, replicates=replicates, seed=seed).withColumnsRenamed({"f1_macro": f"{n}_f1", "recall_neg": f"{n}_recall"})
        for n, df in (("ref", reference), ("cur", current))
    ]
    drops = sides[0].join(sides[1], "replicate").select(
        (F.col("ref_f1") - F.col("cur_f1")).alias("f1_drop"), (F.col("ref_recall") - F.col("cur_recall")).alias("recall_neg_drop")
    )
    limit = F.when(F.col("metric") == "f1_drop", F.lit(f1_drop)).otherwise(F.lit(recall_neg_drop))
    verdict = F.when(F.col("low") > limit, "blocked").when(F.col("high") <= limit, "passed").otherwise("unsure")
    return interval(drops, ["f1_drop", "recall_neg_drop"], level=level).select(
        "metric", "low", "middle", "high", limit.alias("limit"), verdict.alias("verdict")
    )
