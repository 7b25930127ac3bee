import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.operators import drift, metrics
from tests.conftest import values


def brute_psi(ref, cur):
    bins = set(ref) | set(cur)
    r, c = Counter(ref), Counter(cur)
    out = 0.0
    for b in bins:
        x = max(r[b] / len(ref), 1e-4)
        y = max(c[b] / len(cur), 1e-4)
        out += (x - y) * math.log(x / y)
    return out


def reviews(spark, n, negative_percent, shift=0.0, source="yelp"):
    """Deterministic batch: labels by share, ratings around a mean, texts of varying length."""
    label = F.when(F.col("id") % 100 < negative_percent, "negative").otherwise("positive")
    return spark.range(n).select(
        F.expr("repeat('x', cast(id % 50 + 1 as int))").alias("text"), label.alias("label"),
        (F.col("id") % 5 + 1 + shift).cast("double").alias("rating"), F.lit(source).alias("source"),
        ((F.col("id") * 7919 % 1009) / 10 + shift).alias("value"),
    )


def scores(ref, cur, **kw):
    return {r.column: r for r in drift.psi_by_column(ref, cur, **kw).collect()}


def test_categorical_score_by_hand(spark):
    ref, cur = reviews(spark, 400, 20), reviews(spark, 200, 60)
    got = scores(ref, cur, numeric=[], categorical=[])["label"]
    assert got.psi == pytest.approx(brute_psi(["n"] * 80 + ["p"] * 320, ["n"] * 120 + ["p"] * 80))
    assert got.drifted and got.role == "target"


def test_numeric_score_by_hand(spark):
    ref, cur = reviews(spark, 400, 20), reviews(spark, 300, 20, shift=20.0)
    a, b = [r.value for r in ref.collect()], [r.value for r in cur.collect()]
    low, high = min(a + b), max(a + b)
    k = math.ceil(math.log2(700)) + 1
    width = (high - low) / k

    def binned(xs):
        return [min(int((x - low) // width), k - 1) for x in xs]

    got = scores(ref, cur, numeric=["value"], categorical=[], target=None)["value"]
    assert got.psi == pytest.approx(brute_psi(binned(a), binned(b)))


def test_few_values_are_compared_one_by_one(spark):
    ref, cur = reviews(spark, 400, 20), reviews(spark, 400, 20, shift=1.0)
    a, b = [r.rating for r in ref.collect()], [r.rating for r in cur.collect()]
    got = scores(ref, cur, numeric=["rating"], categorical=[], target=None)["rating"]
    assert got.psi == pytest.approx(brute_psi(a, b))


def test_a_batch_does_not_drift_from_itself(spark):
    ref = drift.monitoring_features(reviews(spark, 400, 20))
    row = drift.drift_summary(drift.psi_by_column(ref, ref)).first()
    assert row.drift_score == 0 and not row.drift_blocks and row.n_features == 3


def test_constant_column_and_nulls(spark):
    ref = reviews(spark, 50, 20).withColumn("value", F.lit(3.0))
    cur = ref.withColumn("value", F.when(F.col("rating") > 1, F.lit(3.0)))
    assert scores(ref, cur, numeric=["value"], categorical=[], target=None)["value"].psi == 0.0


def test_shifted_batch_blocks(spark):
    ref = drift.monitoring_features(reviews(spark, 400, 20))
    cur = drift.monitoring_features(reviews(spark, 400, 60, shift=3.0, source="google"))
    row = drift.drift_summary(drift.psi_by_column(ref, cur)).first()
    assert row.drifted_columns == "rating,source" and row.drift_score == pytest.approx(2 / 3)
    assert row.target_drift and row.drift_blocks


def judged(spark, n, constant=None):
    df = reviews(spark, n, 30)
    return df.withColumn("prediction", F.lit(constant) if constant else F.col("label"))


def test_worse_model_blocks_and_the_row_is_kept_first(spark):
    ref, cur = judged(spark, 200), judged(spark, 200, "positive")
    kept = []
    with pytest.raises(drift.PromotionBlocked, match="f1_blocks, recall_neg_blocks"):
        drift.evaluate(ref, cur, kept.append, raise_on_block=True)
    row = kept[0]
    assert row["blocked_promotion"] and not row["drift_blocks"]
    assert row["reference_f1"] == 1.0 and row["recall_neg_drop"] == 1.0
    assert drift.evaluate(ref, cur, kept.append)["blocked_promotion"]


def test_gate_without_a_model_uses_drift_alone(spark):
    row = drift.evaluate(reviews(spark, 200, 30), reviews(spark, 200, 30), lambda r: None)
    assert row["f1_drop"] is None and not row["blocked_promotion"]


@pytest.mark.parametrize("negative, blocked", [(60, True), (20, False)])
def test_scenario_monitor_looks_at_labels_only(spark, negative, blocked):
    stream = reviews(spark, 200, negative, shift=9.0).withColumn("review_date", F.lit("2026-06-21"))
    row = drift.scenario_monitor(reviews(spark, 400, 20), stream, asof="2026-06-30").first()
    assert row.blocked is blocked and row.n_features == 0


def test_monitor_derives_labels_and_survives_missing_data(spark):
    ref = reviews(spark, 300, 20).withColumn("rating", F.when(F.col("label") == "negative", 1.0).otherwise(5.0))
    silver = ref.drop("label").withColumn("review_date", F.lit("2026-06-01"))
    assert drift.monitor(ref, silver).first().target_drift_score == pytest.approx(0.0)
    assert drift.monitor(ref, None).first().blocked is False


def test_metrics_by_hand(frame):
    rows = frame([("n", "n"), ("n", "p"), ("p", "p"), ("p", "p"), ("u", "p"), (None, "p")], "label string, prediction string")
    got = {r.label: r for r in metrics.per_class(metrics.confusion(rows)).collect()}
    assert (got["n"].precision, got["n"].recall, got["u"].f1) == (1.0, 0.5, 0.0)
    row = metrics.summary(rows).first()
    f1_p = 2 * 2 / (4 + 2)
    assert row.f1_macro == pytest.approx((2 / 3 + f1_p + 0) / 3)
    assert row.f1_weighted == pytest.approx((2 * 2 / 3 + 2 * f1_p) / 5)
    assert row.accuracy == pytest.approx(3 / 5) and row.recall_neg == 0.0


def test_metrics_of_nothing(frame):
    row = metrics.summary(frame([], "label string, prediction string")).first()
    assert (row.n_rows, row.f1_macro, row.recall_neg) == (0, 0.0, 0.0)
    assert metrics.quality_gate(metrics.summary(frame([], "label string, prediction string"))).first().promote is False


def test_windows(frame):
    from opinara.operators import windows

    df = frame([("2026-06-01", 1), ("2026-06-03", 2), ("2026-06-07", 3), ("__null__", 4)], "review_date string, x int")
    assert values(windows.recent_partitions(df, 2), "x") == [(2,), (3,)]
    assert values(windows.replay_window(df, "2026-06-06", 1), "x") == [(2,)]
    assert values(windows.replay_window(df), "x") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="no partitions"):
        windows.replay_window(df, "2020-01-01")
    assert [r[0] for r in windows.partition_counts(df).collect()][-1] == "__null__"
