"""Stages that return their input's columns return them as they were, whatever their names."""

import pytest
from pyspark.sql import functions as F

from opinara.llm import decontaminate, order_minhash, pseudonyms, pu_toxicity
from tests.llm.helpers import prose

NAMES = [
    "_bytes", "_BYTES_", "_node", "_Node", "_runs", "_items", "_n_words", "_kept_id", "_kept_node", "_toxicity", "_toxicity_",
    "_found", "_found_", "_moved", "id", "node", "n", "key", "cls", "kept", "class_id", "class_size", "n_links", "common",
    "sketches", "document", "score", "label", "predicted", "held_out", "was", "a.b", "row", "bytes", "feature",
]


def docs(spark):
    texts = [prose(60, k) for k in range(25)] + [f"{prose(50, 90 + k)} grubnik {prose(9, 190 + k)} grubnik" for k in range(25)]
    texts += [texts[0], f"{prose(30, 301)} {prose(15, 999)} {prose(30, 302)}", "card 4111111111111111", None, ""]
    # Two names that differ in case alone are one to Spark.
    names = list({n.lower(): n for n in NAMES}.values())
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return own.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in names])


def toxic(rows):
    labels = rows.select("doc_id", F.coalesce(F.contains("text", F.lit("grubnik")), F.lit(False)).cast("int").alias("toxic"))
    return pu_toxicity.drop_toxic(rows, pu_toxicity.train(rows, labels))


def clean(rows):
    items = rows.sparkSession.createDataFrame([(0, prose(15, 999))], "item_id int, text string")
    return decontaminate.decontaminate(rows, items)


STAGES = {
    "toxicity": (toxic, set(range(25, 50))),
    "near_duplicates": (order_minhash.drop_near_duplicates, {50}),
    "decontamination": (clean, {51}),
    "pseudonyms": (lambda rows: pseudonyms.pseudonymise(rows, "k"), set()),
}


@pytest.mark.parametrize("stage", STAGES)
def test_columns_come_back_as_they_were(spark, stage):
    step, gone = STAGES[stage]
    rows = docs(spark)
    out = step(rows)
    assert out.columns == rows.columns and [f.dataType for f in out.schema.fields] == [f.dataType for f in rows.schema.fields]
    free = [k for k, c in enumerate(rows.columns) if c != "text" or stage != "pseudonyms"]
    pick = lambda rs: {r.doc_id: tuple(r[k] for k in free) for r in rs}
    wanted = pick(r for r in rows.collect() if r.doc_id not in gone)
    assert pick(out.collect()) == wanted and out.count() == len(wanted)
