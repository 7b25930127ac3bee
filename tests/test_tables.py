import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.catalog import queries
from opinara.operators import quality
from opinara.plans import daily
from opinara.schemas import BUSINESS_FIELDS, FLAT_FIELDS, REVIEW_FIELDS, SILVER_PARTITIONED, conform
from opinara.sources import files, tables
from opinara.streaming import jobs, replay
from tests.conftest import values


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def test_json_lines_skip_blank_and_broken(spark, folder):
    path = folder("x.json")
    with open(path, "w") as fh:
        fh.write('{"review_id": "a", "stars": 4.5, "text": null}\n\n   \n{"review_id": "b", "te\nnot json\n{"review_id": "c"}\n')
    got = files.read_json_records(spark, path, REVIEW_FIELDS)
    assert values(got, "review_id", "stars", "text") == [("a", "4.5", None), ("c", None, None)]
    assert got.count() == 2 and got.select("text").count() == 2


def test_csv_keeps_values_as_they_are(spark, folder):
    path = folder("x.csv")
    with open(path, "wb") as fh:
        fh.write('Review,Extra,Rating,Restaurant,Title\n"two\nlines, and ""quotes""",x,5,Kopi Bar,NA\n'.encode())
        fh.write(b" pad ,x,garbage,The Steakhouse,t\nbad \xff byte,x,,Kopi,t\n")
    got = files.read_flat_csv(spark, path, "t0")
    assert values(got, "Review", "Rating", "Title", "Dates", "_source", "_ingested_at") == [
        ("bad � byte", None, "t", None, "tripadvisor", "t0"),
        ('two\nlines, and "quotes"', "5", None, None, "tripadvisor", "t0"),
    ]
    assert files.read_flat_csv(spark, path, "t0", in_scope_only=False).count() == 3
    assert files.read_flat_csv(spark, path, "t0", in_scope_only=False, limit=1).count() == 1


def test_bronze_landings_may_differ_in_columns(spark, frame, folder):
    root = folder("bronze")
    first = frame([("a", "4", "t")], "review_id string, stars string, text string")
    second = frame([("u2", "b", "5")], "text string, review_id string, useful string")
    files.write_bronze(first, root, "yelp", "reviews", "2026-06-06")
    files.write_bronze(second, root, "yelp", "reviews", "2026-06-07")
    got = files.read_bronze(spark, root, "yelp", "reviews", ["2026-06-06", "2026-06-07"])
    assert values(got, "review_id", "stars", "text", "useful") == [("a", "4", "t", None), ("b", None, "u2", "5")]


def rows(frame, *items):
    """Silver rows from (id, date, ingested, text)."""
    data = [(t, len(t), 4.0, "yelp", i, "r", "l", d, at) for i, d, at, t in items]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER_PARTITIONED if f.name != "review_date")
    return frame(data, schema)


def test_late_rows_replace_in_their_own_date_and_reruns_change_nothing(spark, frame, folder):
    root = folder("silver")
    first = rows(frame, ("a", "2021-01-01", "1", "old"), ("b", "2021-01-02", "1", "stays"), ("c", None, "1", "undated"))
    assert daily.upsert_silver(spark, first, root) == ["2021-01-01", "2021-01-02", "__null__"]
    late = rows(frame, ("a", "2021-01-01", "2", "new"), ("d", "2021-01-01", "2", "more"))
    for _ in range(2):
        assert daily.upsert_silver(spark, late, root) == ["2021-01-01"]
    stale = rows(frame, ("a", "2021-01-01", "0", "older still"))
    daily.upsert_silver(spark, stale, root)
    assert values(files.read_silver(spark, root), "source_id", "review_date", "text") == [
        ("a", "2021-01-01", "new"), ("b", "2021-01-02", "stays"), ("c", "__null__", "undated"), ("d", "2021-01-01", "more"),
    ]


def test_absent_table_reads_empty(spark, folder):
    assert files.read_silver(spark, folder("none")).count() == 0
    assert files.read_bronze(spark, folder("none"), "yelp", "reviews", ["2026-06-06"]) is None
    with pytest.raises(ValueError, match="unknown source"):
        files.read_bronze(spark, folder("none"), "blog", "reviews", ["2026-06-06"])


def test_warehouse_merge_moves_a_review_between_dates(spark, frame, folder):
    path = folder("table")

    def put(*items):
        incoming = frame(list(items), "source string, source_id string, text string, review_date string")
        return tables.merge_table(spark, path, incoming, ["source", "source_id"])

    put(("y", "a", "one", "2021-01-01"), ("y", "b", "two", "2021-01-02"), ("y", "c", "three", "2021-01-02"))
    assert put(("y", "a", "moved", "2021-01-03"), ("y", "b", "moved", None)) == 2
    got = spark.read.parquet(path)
    assert values(got, "source_id", "text", "review_date") == [
        ("a", "moved", "2021-01-03"), ("b", "moved", "__null__"), ("c", "three", "2021-01-02"),
    ]
    assert not os.path.exists(f"{path}/review_date=2021-01-01")


def test_replace_table_may_read_what_it_replaces(spark, frame, folder):
    path = folder("t")
    frame([(1,), (2,)], "x int").write.parquet(path)
    assert tables.replace_table(spark.read.parquet(path).where("x = 2"), path) == 1
    assert values(spark.read.parquet(path), "x") == [(2,)]
    tables.append_table(frame([(3,)], "x int"), path)
    assert spark.read.parquet(path).count() == 2


def test_scored_rows(frame):
    schema = "text string, label string, source string, ingested_at timestamp"
    old = frame([], schema)
    scored = frame([("x" * 10_001, "neutral"), ("  ", "neutral"), (None, "neutral")], "text string, label string").withColumns(
        {"source": F.lit("batch"), "ingested_at": F.lit("2026-01-01").cast("timestamp")})
    assert [len(r.text) for r in tables.append_scored(old, scored).collect()] == [10_000]


def land(spark, root, date, text="good tea", stars="5"):
    stamp = {"_source": F.lit("yelp"), "_ingested_at": F.lit(f"{date}T00:00:00Z")}
    review = conform(spark.createDataFrame(
        [("r1", "b1", stars, text, "2022-01-10 08:00:00"), ("r2", "b1", "1", "awful, \"cold\"\ntea", "2022-01-11")],
        "review_id string, business_id string, stars string, text string, date string"), REVIEW_FIELDS)
    business = conform(spark.createDataFrame([("b1", "Cafe", "Austin")], "business_id string, name string, city string"),
                       BUSINESS_FIELDS)
    flat = conform(spark.createDataFrame([("so so", "3", "Reviewed 6 February 2022", "Kopi", "KL")],
                   "Review string, Rating string, Dates string, Restaurant string, Location string"), FLAT_FIELDS)
    files.write_bronze(review.withColumns(stamp), root, "yelp", "reviews", date)
    files.write_bronze(business.withColumns(stamp), root, "yelp", "business", date)
    files.write_bronze(flat.withColumns(stamp), root, "tripadvisor", "reviews", date)


def test_daily_run_end_to_end(spark, folder):
    bronze, silver, gold, warehouse = (folder(n) for n in ("bronze", "silver", "gold", "warehouse"))
    land(spark, bronze, "2026-06-06")
    got = daily.run_daily(spark, "2026-06-06", bronze, silver, gold, warehouse=warehouse)
    assert values(got, "review_date", "n_rows") == [
        ("2022-01-10", 1), ("2022-01-11", 1), ("2022-02-06", 1), ("total", 3),
    ]
    features, labels = files.read_gold(spark, gold)
    joined = features.join(labels.drop("review_date"), "review_id")
    assert values(joined, "text", "label", "review_date") == [
        ('awful, "cold"\ntea', "negative", "2022-01-11"), ("good tea", "positive", "2022-01-10"),
        ("so so", "neutral", "2022-02-06"),
    ]
    land(spark, bronze, "2026-06-07", text="worse now", stars="2")
    daily.run_daily(spark, "2026-06-07", bronze, silver, gold, warehouse=warehouse, sources=["yelp"])
    table = spark.read.parquet(f"{warehouse}/reviews_gold")
    assert table.count() == 3 and table.where("text = 'worse now' AND label = 'negative'").count() == 1
    assert daily.reprocess_date(spark, bronze, silver, "2022-01-10", ["2026-06-06"], ["yelp"]).first().text == "worse now"


def test_bad_silver_stops_before_gold(spark, folder):
    bronze, silver, gold = (folder(n) for n in ("bronze", "silver", "gold"))
    land(spark, bronze, "2026-06-06", text="x" * 6000)
    with pytest.raises(quality.GateFailed, match="2022-01-10"):
        daily.run_daily(spark, "2026-06-06", bronze, silver, gold)
    assert not os.path.exists(gold)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables absent")
def test_the_daily_query_notices_a_broken_stop(spark, monkeypatch):
    monkeypatch.setattr(quality, "check_silver_partitions", lambda silver: None)
    with pytest.raises(RuntimeError, match="does not stop"):
        queries()["s4_daily_run"](spark, "/root/testdata/sf0.001")


def test_raw_rows_are_landed_by_the_daily_run(spark, folder):
    flat = spark.createDataFrame([("so so", "3", "Reviewed 6 February 2022", "Kopi", "KL")],
                                 "Review string, Rating string, Dates string, Restaurant string, Location string")
    bronze, rest = folder("bronze"), [folder("silver"), folder("gold")]
    raw = {("tripadvisor", "reviews"): conform(flat, FLAT_FIELDS)}
    for _ in range(2):
        got = daily.run_daily(spark, "2026-06-06", bronze, *rest, raw=raw)
        assert values(got, "review_date", "n_rows") == [("2022-02-06", 1), ("total", 1)]
    assert files.read_bronze(spark, bronze, "tripadvisor", "reviews", ["2026-06-06"]).count() == 1


def test_nothing_landed_is_an_empty_run(spark, folder):
    got = daily.run_daily(spark, "2026-06-06", folder("b"), folder("s"), folder("g"))
    assert values(got, "review_date", "n_rows") == [("total", 0)]


def test_replay_rows_are_stable_and_ordered(frame):
    df = frame([("b", "negative", "2026-06-21"), ("a", "neutral", "2026-06-07")], "text string, label string, review_date string")
    got = [(r.review_date, r.review_id) for r in replay.replay_rows(df, "spike", "Brand").collect()]
    assert [d for d, _ in got] == ["2026-06-07", "2026-06-21"]
    assert got == [(r.review_date, r.review_id) for r in replay.replay_rows(df, "spike", "Brand").collect()]
    with pytest.raises(ValueError, match="label"):
        replay.replay_rows(df.drop("label"), "spike", "Brand")


def test_streamed_timeline_survives_a_second_arrival(spark, folder):
    """Files arriving between two runs of the query update the days they belong to."""
    source, table, checkpoint = folder("in"), folder("table"), folder("ck")
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("label", T.StringType())])

    def arrive(day, label, n):
        spark.range(n).selectExpr(f"timestamp'{day}' AS ts", f"'{label}' AS label").write.mode("append").parquet(source)

    def run():
        jobs.timeline_table(jobs.timeline(jobs.read_files(spark, source, schema), "ts"), table, checkpoint).awaitTermination()
        return values(spark.read.parquet(table), "period", "n_reviews", "pct_negative")

    arrive("2026-06-01 10:00:00", "negative", 3)
    arrive("2026-06-02 10:00:00", "positive", 2)
    assert run() == [("2026-06-01", 3, 100.0), ("2026-06-02", 2, 0.0)]
    arrive("2026-06-02 23:00:00", "negative", 2)
    assert run() == [("2026-06-01", 3, 100.0), ("2026-06-02", 4, 50.0)]
    alerts = folder("alerts")
    jobs.spike_alerts(jobs.timeline(jobs.read_files(spark, source, schema), "ts"), alerts, folder("ck2")).awaitTermination()
    assert values(spark.read.parquet(alerts), "period", "alert") == [("2026-06-02", True)]


def test_warehouse_tables_have_a_directory_per_day(spark, folder):
    path = folder("warehouse")
    rows = spark.range(600).selectExpr(
        "'s' AS source", "id::string AS source_id", "concat('text ', id) AS text", "5 AS text_len", "3.0D AS rating",
        "'r' AS restaurant", "'l' AS location", "date_format(timestamp_seconds(1700000000 + id * 700), 'yyyy-MM-dd HH:mm:ss') AS date",
        "'2026-06-06' AS _ingested_at",
    )
    for _ in range(2):
        tables.merge_table(spark, path, tables.silver_table_rows(rows), ["source", "source_id"])
    days = {r.date[:10] for r in rows.collect()}
    assert sorted(d for d in os.listdir(path) if d.startswith("day=")) == sorted(f"day={d}" for d in days)
    stored = spark.read.parquet(path)
    assert stored.count() == 600 and {r.review_date for r in stored.collect()} == {r.date for r in rows.collect()}


def test_undated_reviews_survive_stores_and_clearing(spark, folder):
    path = folder("reviews")
    schema = "text string, label string, source string, ingested_at timestamp"
    for k, text in enumerate(["first", "second", "third"]):
        undated = spark.createDataFrame([(text, "neutral", "batch", None)], schema)
        tables.store_reviews(spark, path, undated, "2026-06-06 00:00:00", clear_days=k)
    assert values(tables.read_reviews(spark, path), "text") == [("first",), ("second",), ("third",)]
    old = tables.read_reviews(spark, path)
    assert tables.replace_recent(old, old.limit(0), "2026-06-06 00:00:00").count() == 3


def test_long_texts_are_loaded_whole_where_the_gate_has_no_limit(spark, frame, folder):
    long = "tea " * 3_000 + "end"
    texts = ["good tea", "cold tea", "slow tea", long]
    documents = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    frame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(folder("documents.parquet"))
    labels = [(0, 1, 0), (1, 0, 1), (2, 0, 0), (3, 0, 0)]
    frame(labels, "doc_id long, quality int, toxic int").write.parquet(folder("labels.parquet"))
    got = queries()["a23_truncate_and_load"](spark, folder("").rstrip("/"))
    assert values(got, "text", "refused") == sorted(((t, True) for t in texts), key=str)
    rows = spark.read.parquet(folder("documents.parquet")).selectExpr(
        "text", "element_at(array('neutral', 'positive', 'negative'), int(doc_id % 3 + 1)) AS label", "3.0D AS rating", "source",
        "'r' AS restaurant", "'l' AS location")
    assert not quality.verdict(quality.gold_gate(rows)).success
    assert quality.verdict(quality.gold_gate(rows, max_chars=None)).success
    assert quality.verdict(quality.gold_gate(rows.where("doc_id < 3"), max_chars=8)).success
    assert not quality.verdict(quality.gold_gate(rows.where("doc_id < 3"), max_chars=7)).success


def test_the_daily_run_leaves_its_tables_and_nothing_else(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    bronze, silver, gold, warehouse = (folder(n) for n in ("bronze", "silver", "gold", "warehouse"))
    land(spark, bronze, "2026-06-06")
    for _ in range(2):
        daily.run_daily(spark, "2026-06-06", bronze, silver, gold, warehouse=warehouse)
    assert set(os.listdir(shared)) <= before
    landed = [n for _, _, names in os.walk(bronze) for n in names if n.startswith("part-")]
    assert landed and all(n.endswith(".csv.gz") for n in landed)


def test_a_daily_run_in_many_parts_writes_the_same_tables(spark, folder, monkeypatch):
    def run(name):
        bronze, *rest = (folder(f"{name}-{n}") for n in ("bronze", "silver", "gold"))
        warehouse = folder(f"{name}-warehouse")
        for date, text in (("2026-06-06", "good tea"), ("2026-06-07", "worse now"), ("2026-06-07", "worse now")):
            land(spark, bronze, date, text=text)
            daily.run_daily(spark, date, bronze, *rest, warehouse=warehouse)
        features, labels = files.read_gold(spark, rest[1])
        stored = [spark.read.parquet(f"{warehouse}/{t}") for t in ("reviews_silver", "reviews_gold")]
        return [values(df, *sorted(df.columns)) for df in (files.read_silver(spark, rest[0]), features, labels, *stored)]

    whole = run("whole")
    monkeypatch.setattr(files, "PART_BYTES", 1)
    monkeypatch.setattr(files, "MOST_PARTS", 1_000)
    assert len(list(files.in_parts(files.read_silver(spark, folder("whole-silver"))))) == 3
    assert run("parts") == whole


def test_parts_of_gold_hold_whole_dates(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(files, "PART_BYTES", 1)
    monkeypatch.setattr(files, "MOST_PARTS", 1_000)
    silver = rows(frame, ("a", "2021-01-03", "1", "one"), ("b", "2021-01-03", "1", "two"), ("c", "2021-01-04", "1", "three"))
    days = F.when(F.col("source_id") == "a", "2021-01-01").otherwise("2021-01-02")
    files.write_silver(silver.withColumn("review_date", days), folder("silver"))
    daily.build_gold(spark, folder("silver"), folder("gold"), ["2021-01-01", "2021-01-02"])
    for store in files.read_gold(spark, folder("gold")):
        assert values(store, "review_id", "review_date") == [("a", "2021-01-03"), ("b", "2021-01-03"), ("c", "2021-01-04")]


def test_an_ingestion_in_slices_keeps_one_row_per_review_and_no_shuffle(spark, folder, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    as_java = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava

    def shuffles():
        return {f.getName() for f in as_java(disk.getAllFiles()) if f.getName().startswith("shuffle_")}

    for date, text in (("2026-06-06", "good tea"), ("2026-06-07", "worse now")):
        land(spark, folder("bronze"), date, text=text)
    monkeypatch.setattr(files, "PART_BYTES", 1)
    monkeypatch.setattr(files, "MOST_PARTS", 1_000)
    before = shuffles()
    for _ in range(2):
        days = daily.ingest_to_silver(spark, folder("bronze"), folder("silver"), ["2026-06-06", "2026-06-07"], years=None)
        assert days == ["2022-01-10", "2022-01-11", "2022-02-06"]
        assert values(files.read_silver(spark, folder("silver")), "review_date", "text") == [
            ("2022-01-10", "worse now"), ("2022-01-11", 'awful, "cold"\ntea'), ("2022-02-06", "so so"),
        ]
    for _ in range(50):  # they are removed behind the job's back
        if not shuffles() - before:
            break
        time.sleep(0.2)
    # What is left is of the reads above.
    assert len(shuffles() - before) <= 2


def test_a_run_through_its_gate_or_not_leaves_no_staged_rows(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    for name, text in (("kept", "good tea"), ("refused", "x" * 6000)):
        bronze, silver, gold = (folder(f"{name}-{n}") for n in ("bronze", "silver", "gold"))
        land(spark, bronze, "2026-06-06", text=text)
        try:
            daily.run_daily(spark, "2026-06-06", bronze, silver, gold, check=True)
            refused = False
        except quality.GateFailed:
            refused = True
        assert refused == (name == "refused") == (not os.path.exists(gold))
        assert files.read_silver(spark, silver).count() == 3
    assert set(os.listdir(shared)) <= before
