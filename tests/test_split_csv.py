import random

import pytest

from opinara.sources import files
from opinara.sources.split_csv import read_split_csv, records
from tests.conftest import values


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few dozen bytes, so that most records lie across them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def quoted(value, r):
    if value is None:
        return ""
    needs = any(c in value for c in '",\n\r') or value != value.strip() or not value
    return '"' + value.replace('"', '""') + '"' if needs or r.random() < 0.3 else value


def text(r):
    return "".join(r.choice(['a', 'é', '"', ',', "\n", "\n\n", " ", "日本", "x" * 40, "'", "\\"]) for _ in range(r.randint(0, 12)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_rows_are_those_of_the_whole_file_reader(spark, tiny_splits, tmp_path, seed, end):
    r = random.Random(seed)
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in range(3):
        rows = [[text(r) if r.random() < 0.9 else None for _ in range(3)] for _ in range(r.randint(0, 25))]
        lines = [",".join(quoted(v, r) for v in row) for row in [["Review", "Title", "Rating"], *rows]]
        lines = [x for x in lines if x.strip(",") or x.count(",")]
        tail = end if r.random() < 0.5 else ""
        (folder / f"{k}.csv").write_text(end.join(lines) + tail, newline="")
    whole = spark.read.options(**files.CSV_READ).csv(str(folder))
    split = read_split_csv(spark, str(folder), files.CSV_READ)
    assert split.columns == whole.columns
    assert values(split, *whole.columns) == values(whole, *whole.columns)
    assert records(spark, str(folder)).count() >= whole.count()


def test_a_value_over_many_splits_and_a_short_row(spark, tiny_splits, tmp_path):
    path = tmp_path / "x.csv"
    long = "\n".join(["line " + str(k) for k in range(200)]) + ' ""said"" he'
    path.write_text(f'Review,Title,Rating\n"{long}",t,5\nshort\n,,\n\n"",q,1\n')
    rows = read_split_csv(spark, str(path), files.CSV_READ).collect()
    assert sorted((len(r.Review or ""), r.Title or "-", r.Rating or "-") for r in rows) == [
        (0, "-", "-"), (0, "q", "1"), (5, "-", "-"), (len(long) - 2, "t", "5"),
    ]
    read = spark.read.option("lineSep", "\n").text(str(path))
    assert read.rdd.getNumPartitions() > 10


def test_flat_csv_split_or_whole(spark, tiny_splits, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes('Review,Extra,Rating,Restaurant,Title\n"two\nlines, and ""quotes""",x,5,Kopi Bar,NA\n'.encode() + b" pad ,x,garbage,The Steakhouse,t\nbad \xff byte,x,,Kopi,t\n")
    columns = ["Review", "Rating", "Title", "Dates", "_source", "_ingested_at"]
    whole, split = (files.read_flat_csv(spark, str(path), "t0", split=s) for s in (False, True))
    assert values(split, *columns) == values(whole, *columns) and split.count() == 2
