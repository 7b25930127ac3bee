import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from opinara.operators import bootstrap, changes, metrics, thresholds


def cusum(values, baseline):
    mean = statistics.fmean(values[:baseline])
    spread = statistics.pstdev(values[:baseline]) or 1.0
    up = down = 0.0
    out, since_up, since_down = [], 0, 0
    for k, x in enumerate(values):
        z = (x - mean) / spread
        up, down = max(0.0, up + z - 0.5), max(0.0, down - z - 0.5)
        since_up, since_down = (k + 1 if up <= 1e-12 else since_up), (k + 1 if down <= 1e-12 else since_down)
        change = "up" if up >= 5 else "down" if down >= 5 else None
        standing, start = (down, since_down) if change == "down" else (up, since_up)
        out.append((round(up, 6), round(down, 6), change, start if standing > 1e-12 else None))
    return out


def test_change_points_as_a_plain_loop_finds_them(spark):
    r = random.Random(1)
    series = {"a": [20 + r.random() for _ in range(40)], "b": [20 + r.random() + (6 if k > 25 else 0) for k in range(40)],
              "c": [20 + r.random() - (3 if 15 < k < 30 else 0) for k in range(40)], "flat": [7.0] * 12 + [9.0] * 5, "one": [3.0]}
    rows = [(b, f"2026-{k // 28 + 1:02}-{k % 28 + 1:02}", x) for b, xs in series.items() for k, x in enumerate(xs)]
    df = spark.createDataFrame([*rows, ("a", "2027-01-01", None)], "brand string, day string, share double")
    got = {}
    for x in changes.change_points(df, 10, by=["brand"]).orderBy("brand", "day").collect():
        got.setdefault(x.brand, []).append((round(x.upper, 6), round(x.lower, 6), x.change, x.since))
    for brand, xs in series.items():
        days = [d for b, d, _ in rows if b == brand]
        assert got[brand] == [(u, d, c, None if s is None else days[s]) for u, d, c, s in cusum(xs, 10)], brand
    assert {b for b, xs in got.items() if any(c for _, _, c, _ in xs)} == {"b", "c", "flat"}
    assert changes.change_points(df.where("false"), 10, by=["brand"]).isEmpty()


def weight(key, replicate, seed=42):
    digest = hashlib.sha256(f"{seed}|{replicate // 16}|{key}".encode()).hexdigest()
    bits = int(digest[replicate % 16 * 4 : replicate % 16 * 4 + 4], 16)
    total, k = math.exp(-1), 0
    while bits >= round(total * 65536):
        k += 1
        total += math.exp(-1) / math.factorial(k)
    return k


def scored(spark, n, wrong):
    h = F.pmod(F.xxhash64("id"), F.lit(100))
    label = F.when(F.col("id") % 3 == 0, "negative").when(F.col("id") % 3 == 1, "neutral").otherwise("positive")
    return spark.range(n).select(
        F.col("id").alias("key"), label.alias("label"),
        F.when(h < wrong, "positive").otherwise(label).alias("prediction"), F.lit("x").alias("weight"),
    )


def test_weights_are_poisson_and_the_same_everywhere(spark):
    df = spark.range(3000).withColumn("key", F.col("id").cast("string"))
    got = {(r.key, r.replicate): r.weight for r in bootstrap.weighted(df, F.col("key"), 20).collect()}
    assert all(got.get((str(k), b), 0) == weight(k, b) for k in range(0, 3000, 7) for b in range(20))
    assert abs(sum(got.values()) / 60_000 - 1) < 0.02 and abs(1 - len(got) / 60_000 - math.exp(-1)) < 0.01


def test_replicates_are_the_metrics_of_rows_repeated(spark):
    df = scored(spark, 500, 20).drop("weight")
    rows = df.collect()
    got = {r.replicate: r for r in bootstrap.replicate_metrics(df, "key", replicates=18).collect()}
    assert len(got) == 18
    for b in (0, 15, 16, 17):
        repeated = [(r.label, r.prediction) for r in rows for _ in range(weight(r.key, b))]
        want = metrics.summary(spark.createDataFrame(repeated, "label string, prediction string")).first()
        assert got[b].f1_macro == pytest.approx(want.f1_macro) and got[b].recall_neg == pytest.approx(want.recall_neg)


def test_verdicts_know_how_many_rows_there_are(spark):
    def verdicts(n, wrong):
        old, new = scored(spark, n, 10).drop("weight"), scored(spark, n, wrong).drop("weight")
        return {r.metric: r for r in bootstrap.gate_interval(old, new, "key", replicates=40).collect()}

    assert {r.verdict for r in verdicts(6000, 60).values()} == {"blocked"}
    assert {r.verdict for r in verdicts(6000, 10).values()} == {"passed"}
    few = verdicts(60, 18)
    assert "unsure" in {r.verdict for r in few.values()} and all(r.low <= r.middle <= r.high for r in few.values())


def test_curve_and_choice_by_hand(spark):
    rows = [(0.95, True), (0.9, True), (0.8, False), (0.7, True), (0.2, False), (0.1, False), (1.0, True), (None, True), (0.5, None), (float("nan"), True)]
    df = spark.createDataFrame(rows, "s double, t boolean")
    curve = thresholds.precision_recall(thresholds.score_bins(df, "s", "t", 10), 10).orderBy("threshold").collect()
    assert [(r.threshold, r.n_predicted, r.n_hit) for r in curve] == [(0.1, 7, 4), (0.2, 6, 4), (0.7, 5, 4), (0.8, 4, 3), (0.9, 3, 3)]
    frame = spark.createDataFrame(curve)
    assert thresholds.choose_threshold(frame).first().threshold == 0.7
    assert thresholds.choose_threshold(frame, 0.7).first().threshold == 0.9
    assert thresholds.choose_threshold(frame, 1.1).isEmpty()


def test_steps_rise_and_are_the_closest(spark):
    r = random.Random(3)
    counted = [(b, n := r.randint(1, 30), r.randint(0, n)) for b in sorted(r.sample(range(100), 40))]
    df = spark.createDataFrame(counted, "bin long, n long, n_positive long")
    got = {x.bin: x.probability for x in thresholds.isotonic(df).collect()}
    for t, (b, _, _) in enumerate(counted):
        means = [min(sum(c[2] for c in counted[s : u + 1]) / sum(c[1] for c in counted[s : u + 1]) for u in range(t, 40)) for s in range(t + 1)]
        assert got[b] == pytest.approx(max(means))
    steps = spark.createDataFrame(list(got.items()), "bin long, probability double")
    scores = spark.createDataFrame([(0.0,), (0.999,), (None,), (counted[5][0] / 100 + 0.001,)], "s double")
    out = [x.calibrated for x in thresholds.calibrate(scores, steps, "s", bins=100).collect()]
    assert out[0] == pytest.approx(got[counted[0][0]]) and out[1] == pytest.approx(got[counted[-1][0]])
    assert out[2] is None and out[3] == pytest.approx(got[counted[5][0]])
    assert thresholds.calibrate(scores, steps.where("false"), "s").where("calibrated IS NOT NULL").isEmpty()
    assert thresholds.isotonic(df.where("false")).isEmpty()
