"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions.fixed import LETTER
from opinara.operators import languages, quality
from opinara.schemas import VALID_SOURCES
from opinara.session import stage
from opinara.sources import tables

SOURCES = v.list_sql(VALID_SOURCES)
SILVER_RULES = [
    ("not_null", "text", "true", "text IS NULL"),
    ("length_1_5000", "text", "text IS NOT NULL", "length(text) NOT BETWEEN 1 AND 5000"),
    ("not_null", "text_len", "true", "text_len IS NULL"),
    ("between_1_5000", "text_len", "text_len IS NOT NULL", "text_len NOT BETWEEN 1 AND 5000"),
    ("in_set", "source", "source IS NOT NULL", f"source NOT IN ({SOURCES})"),
    ("between_1_5", "rating", "rating IS NOT NULL", "rating NOT BETWEEN 1 AND 5"),
    ("not_null", "restaurant", "true", "restaurant IS NULL"),
    ("not_null", "location", "true", "location IS NULL"),
    ("not_null", "source_id", "true", "source_id IS NULL"),
]


def rules_sql(rules, relation: str, key: str | None = None) -> str:
    lead, tail = (f"{key}, ", f" GROUP BY {key}") if key else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {lead}'{name}' AS rule, '{column}' AS "column", count(*) FILTER ({checked}) AS n_checked,
  count(*) FILTER ({failed}) AS n_failed, count(*) FILTER ({failed}) = 0 AS success FROM {relation}{tail}"""
        for name, column, checked, failed in rules
    )


@query("j1_silver_gate", f"WITH {v.DOC_SILVER} {rules_sql(SILVER_RULES, 'ds')}")
def silver_gate(spark, sf):
    return quality.silver_gate(v.doc_silver(spark, sf))


GOLD_ROWS = v.LABELLED + """, x AS (SELECT text, CASE WHEN lang = 'es' THEN upper(label) ELSE label END AS label, rating,
  CASE WHEN lang <> 'de' THEN source END AS source, lang AS restaurant, source AS location FROM g)"""
GOLD_RULES = [
    ("not_null", "text", "true", "text IS NULL"),
    ("not_null", "label", "true", "label IS NULL"),
    ("not_null", "source", "true", "source IS NULL"),
    ("in_set", "label", "label IS NOT NULL", "label NOT IN ('negative', 'neutral', 'positive')"),
    ("between_1_5", "rating", "rating IS NOT NULL", "rating NOT BETWEEN 1 AND 5"),
    ("length_5_10000", "text", "text IS NOT NULL", "length(text) NOT BETWEEN 5 AND 10000"),
    ("has_letter", "text", "text IS NOT NULL", f"NOT regexp_matches(text, '{LETTER}')"),
]


@query("j2_gold_gate", f"""WITH {GOLD_ROWS} {rules_sql(GOLD_RULES, 'x')}
UNION ALL SELECT 'columns', '', 6, 0, true
UNION ALL SELECT 'all_labels', 'label', 3, 3 - n, n = 3 FROM (
  SELECT count(DISTINCT label) FILTER (label IN ('negative', 'neutral', 'positive')) AS n FROM x)""")
def gold_gate(spark, sf):
    rows = v.labelled(spark, sf).select(
        "text",
        F.when(F.col("lang") == "es", F.upper("label")).otherwise(F.col("label")).alias("label"),
        "rating",
        F.when(F.col("lang") != "de", F.col("source")).alias("source"),
        F.col("lang").alias("restaurant"),
        F.col("source").alias("location"),
    )
    return quality.gold_gate(rows)


@query("j3_language_gate", f"""WITH {v.DOCUMENTS}, q AS (
  SELECT count(*) AS n_rows, count(*) FILTER (lang IN ('en', 'ms', 'id'))::DOUBLE / count(*) AS share FROM d)
SELECT n_rows, round(share, 9) AS observed_share, share >= 0.8::DOUBLE AS success FROM q""")
def language_gate(spark, sf):
    out = quality.language_gate(v.documents(spark, sf))
    return out.withColumn("observed_share", F.round("observed_share", 9))


@query("j4_gate_by_partition", f"""WITH {v.SILVER}, k AS (SELECT *, date AS review_date FROM s)
{rules_sql(SILVER_RULES, 'k', 'review_date')}""")
def gate_by_partition(spark, sf):
    return quality.silver_gate_by_key(v.silver(spark, sf).withColumn("review_date", F.col("date")))


@query("j5_gate_failures", f"""WITH {v.DOC_SILVER}, q AS ({rules_sql(SILVER_RULES, 'ds')})
SELECT rule, "column", n_failed FROM q WHERE NOT success""")
def gate_failures(spark, sf):
    verdict = quality.verdict(quality.silver_gate(v.doc_silver(spark, sf)))
    rows = [(r["rule"], r["column"], r["n_failed"]) for r in verdict.failures]
    return spark.createDataFrame(rows, "rule string, column string, n_failed long")


@query("j6_table_constraints", f"""WITH {v.LABELLED}, x AS (
  SELECT lang AS review_id, text, CASE WHEN lang = 'es' THEN upper(label) ELSE label END AS label,
    CASE WHEN lang <> 'de' THEN 'derived_from_rating' END AS label_source FROM g)
SELECT 'primary_key' AS rule, 'review_id' AS "column", count(*) - count(DISTINCT review_id) AS n_violations FROM x
UNION ALL SELECT 'not_null', 'text', count(*) FILTER (text IS NULL) FROM x
UNION ALL SELECT 'not_null', 'label_source', count(*) FILTER (label_source IS NULL) FROM x
UNION ALL SELECT 'check', 'label', count(*) FILTER (label NOT IN ('negative', 'neutral', 'positive')) FROM x""")
def table_constraints(spark, sf):
    lang = F.col("lang")
    rows = v.labelled(spark, sf).select(
        lang.alias("review_id"), "text",
        F.when(lang == "es", F.upper("label")).otherwise(F.col("label")).alias("label"),
        F.when(lang != "de", "derived_from_rating").alias("label_source"),
    )
    return tables.constraint_violations(rows, ["review_id"], ["text", "label_source"], "label")


GRAMS = r"""gr AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(word)::BIGINT + 1), lambda k: substr(concat(' ', word, ' '), k, 3))) AS gram
  FROM (SELECT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '\p{L}+')) AS word FROM documents)),
ct AS (SELECT lang, gram, count(*) AS n FROM gr WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY ALL),
bs AS (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS k FROM ct) WHERE k <= 300),
tt AS (SELECT lang, sum(n) AS total FROM ct GROUP BY lang),
pf AS (SELECT lang, gram, round(ln((coalesce(n, 0) + 1)::DOUBLE / (total + (SELECT count(*) FROM bs))) * 1000)::BIGINT AS weight
  FROM (SELECT lang, total, gram FROM tt, bs) LEFT JOIN ct USING (lang, gram)),
sc AS (SELECT gr.doc_id, pf.lang, sum(weight) AS score FROM gr JOIN pf USING (gram) GROUP BY ALL),
dt AS (SELECT doc_id, arg_min(lang, (-score, lang)) AS detected FROM sc GROUP BY doc_id)"""


def learnt(spark, sf):
    """A profile from four fifths of the documents."""
    return languages.learn(v.table(spark, sf, "documents").where("doc_id % 5 <> 0"))


@query("j3_language_profile", f"WITH {GRAMS} SELECT lang, gram, weight FROM pf")
def language_profile(spark, sf):
    return learnt(spark, sf)


@query("j3_identified_languages", f"""WITH {GRAMS}
SELECT doc_id, coalesce(detected, '') AS detected, doc_id % 5 = 0 AS held_out,
  round(avg(CASE WHEN detected = lang THEN 1.0::DOUBLE ELSE 0 END) FILTER (doc_id % 5 = 0 AND lang IS NOT NULL) OVER (), 9) AS held_out_accuracy
FROM documents LEFT JOIN dt USING (doc_id)""")
def identified_languages(spark, sf):
    """Every document's language by its text, and the share that is right among those not learnt from."""
    found = languages.identify(v.table(spark, sf, "documents").select("doc_id", "text", "lang"), learnt(spark, sf), "doc_id")
    found = stage(found.select("doc_id", "lang", "detected"), "languages")
    held_out = F.col("doc_id") % 5 == 0
    right = F.coalesce((F.col("detected") == F.col("lang")).cast("double"), F.lit(0.0))
    accuracy = found.where(held_out & F.col("lang").isNotNull()).agg(F.round(F.avg(right), 9).alias("held_out_accuracy"))
    return found.select("doc_id", F.coalesce("detected", F.lit("")).alias("detected"), held_out.alias("held_out")).join(F.broadcast(accuracy))


@query("j3_gate_by_text", f"""WITH {GRAMS}
SELECT count(*) AS n_rows, round(count(*) FILTER (detected IN ('en', 'fr'))::DOUBLE / count(*), 9) AS observed_share,
  count(*) FILTER (detected IN ('en', 'fr'))::DOUBLE / count(*) >= 0.4::DOUBLE AS success FROM documents LEFT JOIN dt USING (doc_id)""")
def gate_by_text(spark, sf):
    """The language gate over documents without their language column."""
    docs = v.table(spark, sf, "documents").select("doc_id", "text")
    out = languages.text_language_gate(docs, learnt(spark, sf), "doc_id", ["en", "fr"], 0.4)
    return out.withColumn("observed_share", F.round("observed_share", 9))
