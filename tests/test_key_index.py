"""Merges that open only the days the index names, against a plain dictionary."""

import glob
import random

import pytest

from opinara.session import scratch_path
from opinara.sources import files, key_index, tables
from tests.conftest import values

ROWS = "source string, source_id string, text string, review_date string"
KEYS = ["source", "source_id"]


def put(spark, path, rows):
    return tables.merge_table(spark, path, spark.createDataFrame(rows, ROWS), KEYS)


def stored(spark, path):
    return values(spark.read.parquet(path), "source", "source_id", "text", "review_date")


def test_many_merges_leave_the_newest_row_of_each_review(spark):
    path, r, model = scratch_path(spark, "table"), random.Random(4), {}
    days = [None, *(f"2026-01-0{k} 10:00:0{k}" for k in range(1, 7))]
    for step in range(6):
        ids = r.sample([f"id {k}/=%" for k in range(25)], r.randint(1, 12))
        rows = [(r.choice("ab"), i, f"{step}", r.choice(days)) for i in ids]
        put(spark, path, rows)
        model |= {(s, i): (s, i, t, d or "__null__") for s, i, t, d in rows}
        assert stored(spark, path) == sorted(model.values(), key=str)
        held = {d[:10] for *_, d in model.values()}
        assert set(files.partition_keys(spark, path, "day")) == held == key_index.indexed_days(spark, path, KEYS)


def test_other_days_are_not_opened(spark):
    """A day without any key of the batch may even be unreadable; one that has some may not."""
    path = scratch_path(spark, "table")
    put(spark, path, [("y", f"{d}-{k}", "old", f"2026-02-0{d}") for d in range(1, 7) for k in range(40)])
    for d in (1, 4):
        (name,) = glob.glob(f"{path}/day=2026-02-0{d}/*.parquet")
        with open(name, "wb") as f:
            f.write(b"not parquet")
    assert put(spark, path, [("y", "3-7", "moved", "2026-02-06"), ("y", "new", "new", "2026-02-05")]) == 2
    read = files.read_partitions(spark, path, spark.createDataFrame([], ROWS + ", day string").schema, ["2026-02-03", "2026-02-06"], "day")
    assert read.count() == 39 + 41
    with pytest.raises(Exception, match="not a Parquet file|magic"):
        put(spark, path, [("y", "1-7", "moved", "2026-02-06")])


def test_tables_without_an_index_and_broken_runs(spark):
    path = scratch_path(spark, "table")
    rows = spark.createDataFrame([("y", str(k), "old", f"2026-03-0{k % 3 + 1}") for k in range(30)], ROWS)
    files.write_partitions(tables._dated(rows), path, "day")
    assert key_index.indexed_days(spark, path, KEYS) == set()
    put(spark, path, [("y", "0", "moved", "2026-03-02")])
    assert key_index.indexed_days(spark, path, KEYS) == {"2026-03-01", "2026-03-02", "2026-03-03"}
    # A job that died behind the index and before the table: keys in the index that no row has.
    more = spark.createDataFrame([("y", "99", "2026-03-03"), *(("y", str(k), "2026-03-03") for k in range(2, 30, 3))], "source string, source_id string, day string")
    key_index.index_days(more, path, KEYS)
    put(spark, path, [("y", "99", "new", "2026-03-01"), ("y", "2", "moved", "2026-03-01")])
    got = {(r.source_id, r.text, r.review_date) for r in spark.read.parquet(path).collect()}
    assert len(got) == 31 and {("0", "moved", "2026-03-02"), ("99", "new", "2026-03-01"), ("2", "moved", "2026-03-01")} <= got


def test_days_holding_names_the_days_of_the_keys_and_few_others(spark):
    path = scratch_path(spark, "table")
    put(spark, path, [("y", f"{d}-{k}", "x", f"2026-04-{d:02}") for d in range(1, 21) for k in range(50)])
    batch = spark.createDataFrame([("y", "3-1"), ("y", "3-2"), ("y", "17-49"), ("z", "5-5"), (None, "6-6"), ("y", "absent")], "source string, source_id string")
    assert key_index.days_holding(spark, path, batch, KEYS) == {"2026-04-03", "2026-04-17"}
    assert key_index.days_holding(spark, path, batch, KEYS, ["2026-04-03"]) == {"2026-04-17"}
    assert key_index.days_holding(spark, path, batch.where("false"), KEYS) == set()
