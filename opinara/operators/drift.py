"""Population drift (PSI) per column, the promotion gate and the monitors."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text
from opinara.operators import metrics
from opinara.operators.refine import monitoring_features, relabel
from opinara.operators.windows import recent_keys, recent_partitions, replay_window
from opinara.schemas import shared_columns

# Monitored columns and thresholds.
NUMERIC = ["text_len", "rating"]
CATEGORICAL = ["source"]
TARGET = "label"
PREDICTION = "prediction"
PSI_THRESHOLD = 0.25
F1_DROP = 0.03
RECALL_NEG_DROP = 0.05

# Shares are floored here, so an empty bin does not make the score infinite.
FLOOR = 1e-4
# A numeric column with this few reference values is compared value by value.
FEW_VALUES = 20


class PromotionBlocked(RuntimeError):
    """The gate found drift, or a worse model, on the current data."""


@dataclass(frozen=True)
class _Bins:
    """Equal-width bins over the pooled range; width 0 means one value per bin."""

    low: float
    width: float
    count: int

    def of(self, c: Column) -> Column:
        if not self.width:
            return c.cast("string")
        at = F.floor((c - F.lit(self.low)) / F.lit(self.width))
        return F.least(at, F.lit(self.count - 1)).cast("string")


def _clean(df: DataFrame, numeric: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*[
        text.no_nan(F.col(c).cast("double")).alias(c) if c in numeric else F.col(c).cast("string").alias(c)
        for c in columns
    ])


@dataclass(frozen=True)
class _Profile:
    """What scoring needs to know of the columns: bins, and non-null rows per side."""

    bins: dict[str, _Bins]
    rows: dict[str, tuple[int, int]]


def _profile(both: DataFrame, reference: DataFrame, numeric: Sequence[str], columns: Sequence[str]) -> _Profile:
    """One aggregate pass over both sides, no shuffle of rows."""
    in_ref = F.col("_side") == 0
    wanted = [F.count(F.when(in_ref, F.col(c))).alias(f"ref_{c}") for c in columns]
    wanted += [F.count(F.when(~in_ref, F.col(c))).alias(f"cur_{c}") for c in columns]
    for c in numeric:
        wanted += [
            F.min(c).alias(f"low_{c}"),
            F.max(c).alias(f"high_{c}"),
            F.approx_count_distinct(F.when(in_ref, F.col(c)), 0.02).alias(f"values_{c}"),
        ]
    seen = both.agg(*wanted).first()
    # Far more than FEW_VALUES by estimate is settled; near it, count exactly. Few
    # values collapse before the shuffle, so that count is cheap.
    near = [c for c in numeric if seen[f"values_{c}"] <= 5 * FEW_VALUES]
    exact = reference.agg(*[F.count_distinct(c).alias(c) for c in near]).first().asDict() if near else {}
    bins = {}
    for c in numeric:
        low, high, n = seen[f"low_{c}"], seen[f"high_{c}"], seen[f"ref_{c}"] + seen[f"cur_{c}"]
        few = exact.get(c, FEW_VALUES + 1) <= FEW_VALUES
        if few or low is None or high == low:
            bins[c] = _Bins(0.0, 0.0, 0)
        else:
            k = math.ceil(math.log2(n)) + 1
            bins[c] = _Bins(low, (high - low) / k, k)
    return _Profile(bins, {c: (seen[f"ref_{c}"], seen[f"cur_{c}"]) for c in columns})


def _bin_counts(both: DataFrame, bins: dict[str, _Bins], columns: Sequence[str]) -> DataFrame:
    """``column, bin, n_ref, n_cur``: all columns in one long form, one shuffle."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), (bins[c].of(F.col(c)) if c in bins else F.col(c)).alias("bin"))
        for c in columns
    ]))
    long = both.select("_side", pairs.alias("p")).select("_side", "p.column", "p.bin").where("bin IS NOT NULL")
    return long.groupBy("column", "bin").agg(
        F.count_if(F.col("_side") == 0).alias("n_ref"), F.count_if(F.col("_side") == 1).alias("n_cur")
    )


def psi_by_column(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    target: str | None = TARGET,
    prediction: str | None = None,
    threshold: float = PSI_THRESHOLD,
) -> DataFrame:
    """``column, role, psi, drifted`` for every monitored column both frames have."""
    roles = {c: "feature" for c in (*numeric, *categorical)}
    roles.update({c: r for c, r in ((target, "target"), (prediction, "prediction")) if c})
    columns = shared_columns(reference, current, list(roles))
    if not columns:
        empty = "column string, role string, psi double, drifted boolean"
        return reference.sparkSession.createDataFrame([], empty)
    numeric = [c for c in numeric if c in columns]
    ref, cur = (_clean(df, numeric, columns) for df in (reference, current))
    both = ref.withColumn("_side", F.lit(0)).unionByName(cur.withColumn("_side", F.lit(1)))
    profile = _profile(both, ref, numeric, columns)

    def of(values: dict) -> Column:
        """A value per monitored column, looked up by the column's name."""
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("column")]

    t_ref, t_cur = (of({c: float(n[i]) for c, n in profile.rows.items()}) for i in (0, 1))
    r = F.greatest(F.try_divide(F.col("n_ref").cast("double"), t_ref), F.lit(FLOOR))
    c = F.greatest(F.try_divide(F.col("n_cur").cast("double"), t_cur), F.lit(FLOOR))
    both_sides = (t_ref > 0) & (t_cur > 0)
    score = F.when(both_sides, (r - c) * F.ln(r / c)).otherwise(F.lit(0.0))
    psi = _bin_counts(both, profile.bins, columns).groupBy("column").agg(F.sum(score).alias("psi"))
    role = of({c_: roles[c_] for c_ in columns})
    return psi.select("column", role.alias("role"), "psi", (F.col("psi") > threshold).alias("drifted"))


def drift_summary(columns: DataFrame) -> DataFrame:
    """One row: share and list of drifted features, target and prediction drift, block flag."""
    def of(role: str) -> Column:
        return F.col("role") == role

    def score(role: str) -> Column:
        return F.max(F.when(of(role), F.col("psi")))

    def flag(role: str) -> Column:
        return F.coalesce(F.max(F.when(of(role), F.col("drifted"))), F.lit(False))

    n_drifted = F.count_if(of("feature") & F.col("drifted"))
    out = columns.agg(
        F.count_if(of("feature")).alias("n_features"),
        n_drifted.alias("n_drifted"),
        F.concat_ws(
            ",", F.sort_array(F.collect_list(F.when(of("feature") & F.col("drifted"), F.col("column"))))
        ).alias("drifted_columns"),
        score("target").alias("target_drift_score"),
        flag("target").alias("target_drift"),
        score("prediction").alias("prediction_drift_score"),
        flag("prediction").alias("prediction_drift"),
    )
    share = F.coalesce(F.try_divide("n_drifted", "n_features"), F.lit(0.0))
    return out.withColumns({
        "drift_score": share,
        "drift_blocks": (F.col("n_drifted") >= 1) | F.col("target_drift"),
    })


def _facts(df: DataFrame, side: str) -> DataFrame:
    """A one-row quality summary as two facts, so sides can be put together by union."""
    m = metrics.summary(df, TARGET, PREDICTION)
    return m.select(F.inline(F.array(
        F.struct(F.lit(f"{side}_f1").alias("fact"), F.col("f1_macro").alias("value")),
        F.struct(F.lit(f"{side}_recall_neg").alias("fact"), F.col("recall_neg").alias("value")),
    )))


def promotion_gate(
    reference: DataFrame,
    current: DataFrame,
    f1_drop: float = F1_DROP,
    recall_neg_drop: float = RECALL_NEG_DROP,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """One row: drift, model quality on both sides, and whether promotion is blocked.

    Quality is compared when both frames carry a ``prediction`` column.
    """
    drift = drift_summary(psi_by_column(reference, current, numeric, categorical))
    names = ["reference_f1", "current_f1", "reference_recall_neg", "current_recall_neg"]
    if PREDICTION in reference.columns and PREDICTION in current.columns:
        facts = _facts(reference, "reference").unionByName(_facts(current, "current"))
        values = {n: F.max(F.when(F.col("fact") == n, F.col("value"))) for n in names}
        wide = facts.agg(*[v.alias(n) for n, v in values.items()]).first()
        scores = {n: F.lit(wide[n]) for n in names}
    else:
        scores = {n: F.lit(None).cast("double") for n in names}
    out = drift.withColumns(scores)
    out = out.withColumns({
        "f1_drop": F.col("reference_f1") - F.col("current_f1"),
        "recall_neg_drop": F.col("reference_recall_neg") - F.col("current_recall_neg"),
    })
    out = out.withColumns({
        "f1_blocks": F.coalesce(F.col("f1_drop") > f1_drop, F.lit(False)),
        "recall_neg_blocks": F.coalesce(F.col("recall_neg_drop") > recall_neg_drop, F.lit(False)),
    })
    return out.withColumn(
        "blocked_promotion", F.col("drift_blocks") | F.col("f1_blocks") | F.col("recall_neg_blocks")
    )


def evaluate(
    reference: DataFrame, current: DataFrame, record, raise_on_block: bool = False, **gate_options
) -> dict:
    """Run the gate, hand its row to ``record`` first, then raise if asked to."""
    row = promotion_gate(reference, current, **gate_options).first().asDict()
    record(row)
    if row["blocked_promotion"] and raise_on_block:
        reasons = [name for name in ("drift_blocks", "f1_blocks", "recall_neg_blocks") if row[name]]
        raise PromotionBlocked(f"promotion blocked by {', '.join(reasons)}: {row}")
    return row


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """Features, label and, where both sides are scored, prediction; one row."""
    return blocking_report(psi_by_column(reference, current, numeric, categorical, prediction=PREDICTION))


def blocking_report(columns: DataFrame) -> DataFrame:
    """The summary of scored columns, and whether anything drifted."""
    blocked = (F.col("drift_score") > 0) | F.col("target_drift") | F.col("prediction_drift")
    return drift_summary(columns).withColumn("blocked", blocked)


def monitor(reference: DataFrame, silver: DataFrame | None, n_partitions: int = 7, score=None) -> DataFrame:
    """Reference against the newest Silver partitions, labels derived from ratings.

    Without Silver data the reference is compared with itself. ``score`` adds a
    ``prediction`` column to a frame.
    """
    ref = monitoring_features(reference)
    if silver is None or not recent_keys(silver, 1):
        cur = ref
    else:
        cur = monitoring_features(recent_partitions(silver, n_partitions))
        if "rating" in cur.columns:
            cur = relabel(cur)
    if score is not None:
        ref, cur = score(ref), score(cur)
    return drift_report(ref, cur)


def scenario_monitor(
    reference: DataFrame, stream: DataFrame, asof: str | None = None, n: int | None = None
) -> DataFrame:
    """A replay window against its reference, on the label alone."""
    window = replay_window(stream, asof, n)
    return drift_report(reference.select(TARGET), window.select(TARGET), [], [])


