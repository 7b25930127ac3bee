import math

import pytest
from pyspark.sql import functions as F

from opinara.operators import drift, profiles
from opinara.session import scratch_path
from tests.conftest import values

ROWS = "review_date string, value double, rating double, source string, label string"
OPTIONS = {"numeric": ["value", "rating"], "categorical": ["source", "label"]}
ROLES = profiles.roles_of(["value", "rating"], ["source"])


def rows(spark, n, days, seed, shift=0.0):
    h = F.xxhash64("id", F.lit(seed))
    return spark.range(n).select(
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % days).cast("int")), "yyyy-MM-dd").alias("review_date"),
        ((h % 5000) / 100 + shift).alias("value"),
        F.when(h % 11 != 0, (h % 5 + 1).cast("double")).alias("rating"),
        F.when(h % 7 < 3, "a").when(h % 7 < 5, "b").otherwise(None).alias("source"),
        F.when((h + F.col("id") % days) % 4 == 0, "negative").otherwise("positive").alias("label"),
    )


def as_dict(df):
    return {r.column: (r.role, round(r.psi, 9), r.drifted) for r in df.collect()}


@pytest.mark.parametrize("shift", [0.0, 30.0, -200.0])
def test_scores_are_those_of_the_rows(spark, shift):
    ref, cur = rows(spark, 4000, 9, 1), rows(spark, 3000, 5, 2, shift)
    want = as_dict(drift.psi_by_column(ref, cur, ["value", "rating"], ["source"]))
    got = as_dict(profiles.psi_of_profiles(profiles.profile(ref, **OPTIONS), profiles.profile(cur, **OPTIONS), ROLES))
    assert got == want and len(got) == 4


def test_profiles_add_up_however_rows_are_dealt(spark):
    df = rows(spark, 5000, 6, 3)
    whole = profiles.merge_profiles(profiles.profile(df, **OPTIONS))
    parts = [profiles.profile(df.where(f"pmod(hash(value, rating), 3) = {k}"), **OPTIONS) for k in range(3)]
    merged = profiles.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    columns = ["column", "bin", "cell", "n", "low", "high"]
    assert values(whole, *columns) == values(merged, *columns)


def test_a_date_is_profiled_anew_alone(spark):
    root = scratch_path(spark, "profiles")
    df = rows(spark, 3000, 5, 4)
    profiles.write_profiles(df.where("review_date <> '2026-01-03' OR value < 10"), root, **OPTIONS)
    before = spark.read.parquet(root).where("review_date <> '2026-01-03'").select(F.input_file_name().alias("f")).distinct()
    kept = {r.f for r in before.collect()}
    profiles.write_profiles(df.where("review_date = '2026-01-03'"), root, **OPTIONS)
    after = spark.read.parquet(root).where("review_date <> '2026-01-03'").select(F.input_file_name().alias("f")).distinct()
    assert {r.f for r in after.collect()} == kept
    columns = ["review_date", "column", "bin", "cell", "n"]
    assert values(profiles.read_profiles(spark, root), *columns) == values(profiles.profile(df, **OPTIONS), *columns)


def test_cells_hold_numbers_to_a_part_in_two_to_the_bits(spark, frame):
    numbers = [0.0, -0.0, 1.0, 3.0, -3.0, 12.34, 12.35, 1e-300, -1e300, 123456.0, 123457.0, float("inf"), 7 - 1e-15, 8 - 1e-15]
    df = frame([(x,) for x in numbers], "x double").select("x", profiles.cell(F.col("x"), 20).alias("c"))
    for r in df.collect():
        assert r.c <= r.x or r.x == 1e-300 or abs(r.x) < 1e-290
        assert r.c == r.x or abs(r.x - r.c) <= abs(r.x) * 2.0**-19 or abs(r.x) < 1e-290
    assert df.select("c").distinct().count() >= 11
    coarse = rows(spark, 20_000, 3, 5)
    exact = sorted(r.value for r in coarse.collect())
    got = {r.probability: r.value for r in profiles.profile_quantiles(
        profiles.profile(coarse, numeric=["value"], categorical=[], bits=5), [0.1, 0.5, 0.99]).collect()}
    for p, x in got.items():
        true = exact[math.ceil(p * len(exact)) - 1]
        assert abs(x - true) <= abs(true) * 2.0**-5 + 1e-9
    assert profiles.profile(coarse, numeric=["value"], categorical=[], bits=5).groupBy("review_date").count().agg(F.max("count")).first()[0] < 600


def test_every_date_against_the_days_before(spark):
    df = rows(spark, 6000, 9, 6).where("review_date <> '2026-01-05'").unionByName(
        rows(spark, 40, 1, 7).withColumn("review_date", F.lit(None).cast("string"))
    )
    got = {}
    for r in profiles.psi_by_day(profiles.profile(df, **OPTIONS), 2, ROLES).collect():
        got.setdefault(r.review_date, {})[r.column] = (r.role, round(r.psi, 9), r.drifted)
    days = [f"2026-01-0{k}" for k in (1, 2, 3, 4, 6, 7, 8, 9)]
    want = {}
    for day in days:
        ref = df.where(F.to_date("review_date").between(F.date_sub(F.lit(day).cast("date"), 2), F.date_sub(F.lit(day).cast("date"), 1)))
        if not ref.isEmpty():
            want[day] = as_dict(drift.psi_by_column(ref, df.where(F.col("review_date") == day), ["value", "rating"], ["source"]))
    assert got == want and "2026-01-01" not in got and "2026-01-06" in got


def test_the_monitor_from_profiles_and_empty_tables(spark):
    base = rows(spark, 2000, 12, 8).withColumn("text", F.repeat(F.lit("x"), (F.col("value")).cast("int") + 1))
    reference, stored = scratch_path(spark, "ref"), scratch_path(spark, "stored")
    profiles.write_profiles(drift.monitoring_features(base).withColumn("review_date", F.lit("r")), reference)
    profiles.write_monitoring_profiles(base, stored)
    got = profiles.monitor_profiles(profiles.read_profiles(spark, reference), profiles.read_profiles(spark, stored), 4)
    want = drift.monitor(base, base, 4)
    assert [round(x, 9) if isinstance(x, float) else x for x in got.first()] == [round(x, 9) if isinstance(x, float) else x for x in want.first()]
    empty = profiles.profile(base.where("false"), **OPTIONS)
    assert empty.isEmpty() and profiles.psi_of_profiles(empty, empty, ROLES).isEmpty()
    assert profiles.read_profiles(spark, stored + "-absent").isEmpty()


def test_scoring_profiles_reads_no_review(spark):
    root = scratch_path(spark, "profiles")
    profiles.write_profiles(rows(spark, 1000, 4, 9), root, **OPTIONS)
    stored = profiles.read_profiles(spark, root)
    window = stored.where(F.col("review_date").isin("2026-01-01"))
    plan = window._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and "2026-01-01" in plan.split("PartitionFilters")[1].splitlines()[0]
