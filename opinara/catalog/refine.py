"""Row selection, refinement, joins, deduplication, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions.fixed import BRAND_ALIASES, CHAIN_TERMS, GENERIC_TERMS, LETTER
from opinara.operators import gold, refine, splits
from opinara.plans.daily import keyed, merge_rows
from opinara.schemas import REVIEWS_GOLD, REVIEWS_SILVER, require
from opinara.sources import tables

SCOPE = ["ring", "widget"]
SCOPE_SQL = "list_has_any(string_split(categories, ', '), ['ring', 'widget'])"
LABEL_SQL = "CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END"
SILVER_ORDER = "_ingested_at DESC, text DESC, text_len DESC, rating DESC, restaurant DESC, location DESC, date DESC"
TIES = ["text", "text_len", "rating", "restaurant", "location", "date"]


# ---------- filters ----------

@query("b1_category_scope", f"""WITH {v.BUSINESSES}
SELECT business_id, name FROM b WHERE {SCOPE_SQL}""")
def category_scope(spark, sf):
    current = refine.newest_business(v.businesses(spark, sf))
    return refine.businesses_in_scope(current, SCOPE).select("business_id", "name")


@query("b2_reviews_in_scope", f"""WITH {v.LINES}, {v.BUSINESSES}
SELECT review_id, business_id, stars, text FROM r WHERE business_id IN (SELECT business_id FROM b WHERE {SCOPE_SQL})""")
def reviews_in_scope(spark, sf):
    scope = refine.businesses_in_scope(v.businesses(spark, sf), SCOPE)
    return refine.reviews_in_scope(v.reviews(spark, sf), scope).select("review_id", "business_id", "stars", "text")


@query("f3_first_n", f"""WITH {v.LINES}, {v.BUSINESSES}
SELECT review_id FROM r WHERE business_id IN (SELECT business_id FROM b WHERE {SCOPE_SQL}) ORDER BY review_id LIMIT 100""")
def first_n(spark, sf):
    scope = refine.businesses_in_scope(v.businesses(spark, sf), SCOPE)
    return refine.reviews_in_scope(v.reviews(spark, sf), scope, limit=100).select("review_id")


SHOP = """n AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'The Steakhouse ' WHEN 1 THEN 'Café '
  WHEN 2 THEN 'my ChaTime-' ELSE 'Old Tea House, ' END || p_name AS shop FROM part)"""


def shops(spark, sf):
    kind = F.col("p_size") % 4
    front = (
        F.when(kind == 0, "The Steakhouse ").when(kind == 1, "Café ").when(kind == 2, "my ChaTime-")
        .otherwise("Old Tea House, ")
    )
    return v.table(spark, sf, "part").select("p_partkey", F.concat(front, "p_name").alias("shop"))


@query("b3_name_filter", f"""WITH {SHOP}
SELECT p_partkey, shop FROM n WHERE regexp_matches(lower(shop),
  '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(GENERIC_TERMS)})($|[^\\p{{L}}\\p{{N}}_])|{'|'.join(CHAIN_TERMS)}')""")
def name_filter(spark, sf):
    return refine.names_in_scope(shops(spark, sf), "shop")


@query("b3_name_filter_keywords", f"""WITH {SHOP}
SELECT p_partkey, shop FROM n WHERE contains(lower(shop), 'steak') OR contains(lower(shop), 'widget')""")
def name_filter_keywords(spark, sf):
    return refine.names_in_scope(shops(spark, sf), "shop", ["Steak", "widget"])


FLAT = v.DOCUMENTS + f""", fl AS (
  SELECT {v.strip_sql("text")} AS text, rating, 'tripadvisor' AS source, lang AS restaurant, source AS location, date
  FROM d WHERE rating BETWEEN 1 AND 5), flat AS (
  SELECT text, length(text)::INTEGER AS text_len, rating, source, sha256(concat(restaurant, '|', text, '|', date)) AS source_id,
    restaurant, location, date, '' AS _ingested_at FROM fl WHERE text <> '')"""


@query("b4_refine_flat", f"WITH {FLAT} SELECT * FROM flat")
def refine_flat(spark, sf):
    return refine.refine_flat(v.flat_bronze(spark, sf))


JOINED = v.LINES + ", " + v.BUSINESSES + """, joined AS (
  SELECT text, length(text)::INTEGER AS text_len, stars AS rating, 'yelp' AS source, review_id AS source_id, name AS restaurant,
    city || ', ' || state AS location, date, _ingested_at FROM r JOIN b USING (business_id) WHERE stars BETWEEN 1 AND 5)"""


@query("b5_refine_joined", f"WITH {JOINED} SELECT * FROM joined")
def refine_joined(spark, sf):
    return refine.refine_joined(v.reviews(spark, sf).drop("source"), v.businesses(spark, sf), with_state=True)


@query("c1_business_lookup", f"""WITH {v.LINES}, {v.BUSINESSES}
SELECT name, count(*) AS n_reviews, count(DISTINCT review_id) AS n_ids FROM r JOIN b USING (business_id) GROUP BY name""")
def business_lookup(spark, sf):
    dim = refine.newest_business(v.businesses(spark, sf)).select("business_id", "name")
    joined = v.reviews(spark, sf).select("business_id", "review_id").join(dim, "business_id")
    return joined.groupBy("name").agg(
        F.count("*").alias("n_reviews"), F.count_distinct("review_id").alias("n_ids")
    )


@query("c2_semi_join", f"""WITH {v.LINES}, {v.BUSINESSES}
SELECT source, count(*) AS n_rows FROM r WHERE business_id IN (SELECT business_id FROM b WHERE {SCOPE_SQL}) GROUP BY source""")
def semi_join(spark, sf):
    scope = refine.businesses_in_scope(v.businesses(spark, sf), SCOPE).select("business_id")
    kept = v.reviews(spark, sf).join(scope, "business_id", "left_semi")
    return kept.groupBy("source").agg(F.count("*").alias("n_rows"))


@query("b6_soft_clean", f"""WITH {v.LABELLED}, c AS (
  SELECT {v.strip_sql("text")} AS text, CASE WHEN lang = 'es' THEN upper(label) ELSE label END AS label, rating,
    source, lang AS restaurant, source AS location FROM g)
SELECT * FROM c WHERE length(text) >= 5 AND regexp_matches(text, '{LETTER}') AND label IN ('negative', 'neutral', 'positive')""")
def soft_clean(spark, sf):
    rows = v.labelled(spark, sf).select(
        "text",
        F.when(F.col("lang") == "es", F.upper("label")).otherwise(F.col("label")).alias("label"),
        "rating", "source", F.col("lang").alias("restaurant"), F.col("source").alias("location"),
    )
    return refine.soft_clean(rows)


@query("b7_required_columns", f"WITH {v.DOCUMENTS} SELECT lang, count(*) AS n_rows FROM d GROUP BY lang")
def required_columns(spark, sf):
    return require(v.documents(spark, sf), ["text", "rating", "lang"], "documents").groupBy("lang").agg(
        F.count("*").alias("n_rows")
    )


@query("b8_monitoring_features", f"""WITH {v.LABELLED}
SELECT text, length(text)::INTEGER AS text_len, CASE WHEN lang = 'en' THEN rating END AS rating, source, label FROM g""")
def monitoring_features(spark, sf):
    shown = F.when(F.col("lang") == "en", F.col("rating").cast("string")).otherwise("n/a")
    return refine.monitoring_features(v.labelled(spark, sf).withColumn("rating", shown))


@query("b9_relabel", f"""WITH {v.EVENTS}
SELECT id, {LABEL_SQL} AS label FROM e WHERE source <> 'view'""")
def relabel(spark, sf):
    rating = F.when(F.col("source") != "view", F.col("rating"))
    return refine.relabel(v.events(spark, sf).withColumn("rating", rating)).select("id", "label")


@query("b10_rename_columns", f"""WITH {v.SILVER}
SELECT source, source_id, text, text_len, rating, restaurant, location, date AS review_date, _ingested_at AS ingested_at FROM s""")
def rename_columns(spark, sf):
    return tables.as_reviews_silver(v.silver(spark, sf)).select(*REVIEWS_SILVER)


@query("b11_combined_gold", f"""WITH {v.DOC_SILVER}
SELECT text, CASE WHEN restaurant = 'en' THEN 'neutral' ELSE {LABEL_SQL} END AS label, rating, source, restaurant,
  location, date FROM ds""")
def combined_gold(spark, sf):
    given = F.when(F.col("restaurant") == "en", "neutral")
    return refine.combined_gold(v.doc_silver(spark, sf).withColumn("label", given))


@query("b12_scoring_status", f"""WITH {v.DOCUMENTS}, x AS (
  SELECT doc_id, CASE WHEN lang = 'de' THEN chr(8203) || ' ' || chr(10) ELSE text END AS text FROM d)
SELECT doc_id, CASE WHEN length(text) > 1000 THEN 'too_long' WHEN NOT regexp_matches(text, '[^\\p{{C}}\\p{{Z}}]') THEN 'empty'
  ELSE 'ok' END AS status FROM x""")
def scoring_status(spark, sf):
    blank = F.when(F.col("lang") == "de", F.lit("​ \n")).otherwise(F.col("text"))
    return refine.scoring_status(v.documents(spark, sf).withColumn("text", blank)).select("doc_id", "status")


@query("b13_feature_store", f"""WITH {v.SILVER}
SELECT source_id AS review_id, date AS review_date, text FROM s""")
def feature_store(spark, sf):
    return gold.feature_store(keyed(v.silver(spark, sf)))


@query("b14_label_store", f"""WITH {v.DOC_SILVER}
SELECT source_id AS review_id, date AS review_date, {LABEL_SQL} AS label FROM ds""")
def label_store(spark, sf):
    return gold.label_store(keyed(v.doc_silver(spark, sf)))


@query("b15_shift_dates", f"""WITH {v.EVENTS}
SELECT id, strftime(ts::DATE + (DATE '2026-06-30' - (SELECT max(ts)::DATE FROM e))::INTEGER, '%Y-%m-%d') AS review_date FROM e""")
def shift_dates(spark, sf):
    return refine.shift_dates(v.events(spark, sf).select("id", "review_date"), "2026-06-30")


ALIASES_SQL = "|".join(sorted(BRAND_ALIASES, key=len, reverse=True)).replace("'", "''")
BRAND_TEXT = """bt AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'At Starbucks ' WHEN 'fr' THEN 'pretty McDonald''s, '
  WHEN 'de' THEN 'Costa Rica ' ELSE 'dunkin donuts and Subway ' END || text AS text FROM d)"""


@query("b16_rename_brands", f"""WITH {v.DOCUMENTS}, {BRAND_TEXT}, a AS (
  SELECT doc_id, text, regexp_replace(text, '(?i)\\b(?:{ALIASES_SQL})\\b', 'OurBrand', 'g') AS after FROM bt)
SELECT doc_id, after AS text, text <> after AS changed FROM a""")
def rename_brands(spark, sf):
    lang = F.col("lang")
    front = (
        F.when(lang == "en", "At Starbucks ").when(lang == "fr", "pretty McDonald's, ")
        .when(lang == "de", "Costa Rica ").otherwise("dunkin donuts and Subway ")
    )
    noted = v.documents(spark, sf).select("doc_id", F.concat(front, "text").alias("text"))
    return refine.rename_brands(noted, "OurBrand")


# ---------- Bronze extraction ----------

@query("a3_stamp", f"""WITH {v.DOCUMENTS}
SELECT doc_id, text, 'web' AS _source, '2026-06-06T00:00:00Z' AS _ingested_at FROM d""")
def stamp(spark, sf):
    return refine.stamp(v.documents(spark, sf).select("doc_id", "text"), "web", "2026-06-06T00:00:00Z")


@query("a4_listed_categories", f"""WITH {v.BUSINESSES} SELECT business_id, name FROM b WHERE {SCOPE_SQL}""")
def listed_categories(spark, sf):
    """Half of the businesses have their categories as the text of a JSON list."""
    current = refine.newest_business(v.businesses(spark, sf))
    listed = F.to_json(F.split("categories", ", "))
    mixed = F.when(F.col("business_id").cast("long") % 2 == 0, listed).otherwise(F.col("categories"))
    return refine.businesses_in_scope(current.withColumn("categories", mixed), SCOPE).select("business_id", "name")


@query("a4_extract_bronze", f"""WITH {v.LINES}, {v.BUSINESSES}, k AS (SELECT * FROM b WHERE {SCOPE_SQL})
SELECT 'reviews' AS part, review_id AS id, business_id, 'yelp' AS _source, '2026-06-06T00:00:00Z' AS _ingested_at
FROM r WHERE business_id IN (SELECT business_id FROM k)
UNION ALL SELECT 'business', name, business_id, 'yelp', '2026-06-06T00:00:00Z' FROM k""")
def extract_bronze(spark, sf):
    current = refine.newest_business(v.businesses(spark, sf)).drop("_ingested_at")
    rows, shops_ = refine.extract_bronze(
        v.reviews(spark, sf).drop("_ingested_at"), current, "2026-06-06T00:00:00Z", SCOPE
    )
    shown = ["business_id", "_source", "_ingested_at"]
    return rows.select(F.lit("reviews").alias("part"), F.col("review_id").alias("id"), *shown).unionByName(
        shops_.select(F.lit("business").alias("part"), F.col("name").alias("id"), *shown)
    )


# ---------- dedup, recency, union ----------

@query("e1_dedup_latest", f"""WITH {v.SILVER}
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY {SILVER_ORDER}) AS rn FROM s)
WHERE rn = 1""")
def dedup_latest(spark, sf):
    return refine.dedup_silver(v.silver(spark, sf), TIES)


@query("e2_recent_years", f"""WITH {v.SILVER}, x AS (
  SELECT source, max(date::TIMESTAMP) - INTERVAL 3 YEAR AS floor FROM s GROUP BY source)
SELECT s.* FROM s JOIN x USING (source) WHERE date::TIMESTAMP >= floor""")
def recent_years(spark, sf):
    return refine.recent_years(v.silver(spark, sf), 3)


@query("g1_union_refined", f"""WITH {FLAT}, {JOINED}, u AS (SELECT * FROM joined UNION ALL SELECT * FROM flat)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY {SILVER_ORDER}) AS rn FROM u)
WHERE rn = 1""")
def union_refined(spark, sf):
    joined = refine.refine_joined(v.reviews(spark, sf).drop("source"), v.businesses(spark, sf), with_state=True)
    return refine.union_refined([joined, refine.refine_flat(v.flat_bronze(spark, sf))], TIES)


@query("g2_union_raw", f"""WITH {v.DOCUMENTS}, u AS (
  SELECT {v.strip_sql("text")} AS text, rating, CASE WHEN lang = 'en' THEN 'google' ELSE 'tripadvisor' END AS source,
    lang AS restaurant, source AS location FROM d)
SELECT *, {LABEL_SQL} AS label FROM u WHERE text <> ''""")
def union_raw(spark, sf):
    rows = v.documents(spark, sf).select(
        "text", F.col("rating").cast("string").alias("rating"), F.col("lang").alias("restaurant"),
        F.col("source").alias("location"),
    )
    english = F.col("restaurant") == "en"
    return refine.raw_sample_rows({"google": rows.where(english), "tripadvisor": rows.where(~english)})


# ---------- keyed merge ----------

@query("a19_upsert_silver", f"""WITH {v.SILVER}, t AS (SELECT *, 0 AS late FROM s WHERE date < '1999-01-01'),
  n AS (SELECT * REPLACE ('new ' || text AS text), 1 AS late FROM s WHERE date >= '1998-06-01'),
  pick AS (SELECT *, row_number() OVER (PARTITION BY source, source_id, late ORDER BY {SILVER_ORDER}) AS rn FROM
    (SELECT * FROM t UNION ALL SELECT * FROM n)),
  one AS (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY late DESC) AS k FROM pick WHERE rn = 1)
SELECT source, source_id, text, text_len, rating, restaurant, location, date AS review_date, _ingested_at AS ingested_at
FROM one WHERE k = 1""")
def upsert_silver(spark, sf):
    rows = v.silver(spark, sf)
    target = tables.as_reviews_silver(refine.dedup_silver(rows.where("date < '1999-01-01'"), TIES))
    incoming = rows.where("date >= '1998-06-01'").withColumn("text", F.concat(F.lit("new "), "text"))
    return tables.upsert_silver(target, refine.dedup_silver(incoming, TIES))


@query("a20_upsert_gold", f"""WITH {v.LABELLED}, t AS (
  SELECT l.review_id, review_date, text, label, 'derived_from_rating' AS label_source, length(text)::INTEGER AS text_len,
    '2026-01-01' AS built FROM f JOIN l USING (review_id)),
  n AS (SELECT review_id, review_date, text, 'neutral' AS label, 'derived_from_rating' AS label_source,
    length(text)::INTEGER AS text_len, '2026-06-06' AS built FROM f WHERE review_date >= '2022-01-01')
SELECT * FROM n UNION ALL SELECT * FROM t WHERE review_id NOT IN (SELECT review_id FROM n)""")
def upsert_gold(spark, sf):
    joined = v.features(spark, sf).join(v.doc_labels(spark, sf), "review_id")
    target = joined.withColumns({
        "label_source": F.lit("derived_from_rating"), "text_len": F.length("text"),
        "built_at": F.lit("2026-01-01").cast("timestamp"),
    }).select(*REVIEWS_GOLD)
    incoming = v.features(spark, sf).where("review_date >= '2022-01-01'").withColumn("label", F.lit("neutral"))
    merged = tables.upsert_gold(target, incoming, "2026-06-06")
    return merged.withColumn("built", v.day_text("built_at")).drop("built_at")


@query("s2_late_arrivals", f"""WITH {v.SILVER}, u AS (
  SELECT *, date AS review_date FROM s UNION ALL
  SELECT * REPLACE ('edited ' || text AS text, 5.0::DOUBLE AS rating, '2030-01-01' AS _ingested_at), date FROM s WHERE restaurant LIKE '%1')
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY review_date, source, source_id ORDER BY
  _ingested_at DESC, text DESC, text_len DESC, rating DESC, restaurant DESC, location DESC, date DESC) AS rn FROM u) WHERE rn = 1""")
def late_arrivals(spark, sf):
    rows = v.silver(spark, sf)
    late = rows.where("restaurant LIKE '%1'").withColumns({
        "text": F.concat(F.lit("edited "), "text"), "rating": F.lit(5.0), "_ingested_at": F.lit("2030-01-01"),
    })
    return merge_rows(keyed(rows), keyed(late))


# ---------- Gold joins ----------

@query("c3_training_frame", f"WITH {v.LABELLED} SELECT text, label, review_date FROM f JOIN l USING (review_id)")
def training_frame(spark, sf):
    return gold.training_frame(v.features(spark, sf), v.doc_labels(spark, sf))


@query("c4_gold_rows", f"""WITH {v.LABELLED}
SELECT review_id, review_date, text, label, length(text)::INTEGER AS text_len, 'derived_from_rating' AS label_source
FROM f LEFT JOIN l USING (review_id)""")
def gold_rows(spark, sf):
    return gold.gold_rows(v.features(spark, sf), v.doc_labels(spark, sf))


@query("c7_human_corrections", f"""WITH {v.LABELLED}, h AS (
  SELECT user_id::VARCHAR AS review_id, arg_max(CASE event_type WHEN 'error' THEN 'negative' WHEN 'view' THEN 'neutral'
    ELSE 'positive' END, (ts, event_id)) AS corrected FROM events GROUP BY 1)
SELECT l.review_id, coalesce(corrected, label) AS label,
  CASE WHEN corrected IS NULL THEN 'derived_from_rating' ELSE 'human' END AS label_source
FROM l LEFT JOIN h USING (review_id)""")
def human_corrections(spark, sf):
    kind = F.col("event_type")
    corrections = v.table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("review_id"),
        F.when(kind == "error", "negative").when(kind == "view", "neutral").otherwise("positive").alias(
            "corrected_label"
        ),
        F.col("ts").alias("corrected_at"),
    )
    return gold.apply_corrections(v.doc_labels(spark, sf), corrections)


@query("m7_training_fallback", f"""WITH {v.LABELLED}
SELECT text, label, NULL::VARCHAR AS review_date FROM g""")
def training_fallback(spark, sf):
    empty = v.features(spark, sf).where("review_id IS NULL")
    fallback = v.labelled(spark, sf).select("text", "label")
    return gold.training_frame(empty, v.doc_labels(spark, sf), fallback)


# ---------- splits ----------

ORDER = "substr(md5(concat('42|', review_id)), 1, 15)"


@query("e3_oot_cutoff", f"""WITH {v.EVENTS}, k AS (
  SELECT greatest(1, round_even(count(ts) * 0.2::DOUBLE, 0)::BIGINT) AS n FROM e),
  o AS (SELECT ts, row_number() OVER (ORDER BY ts DESC) AS rn FROM e),
  c AS (SELECT ts AS cutoff FROM o, k WHERE rn = n)
SELECT strftime(cutoff, '%Y-%m-%d %H:%M:%S.%f') AS cutoff, count(*) FILTER (ts >= cutoff) AS n_oot,
  count(*) FILTER (ts < cutoff) AS n_in_time FROM e, c GROUP BY cutoff""")
def oot_cutoff(spark, sf):
    e = v.events(spark, sf)
    cutoff = F.lit(splits.oot_cutoff(e, "ts", 0.2))
    return e.agg(F.count_if(F.col("ts") >= cutoff).alias("n_oot"), F.count_if(F.col("ts") < cutoff).alias("n_in_time")).select(
        v.stamp_text(cutoff).alias("cutoff"), "n_oot", "n_in_time"
    )


@query("e9_balanced_sample", f"""WITH {v.LABELLED}, o AS (
  SELECT review_id, label, rating, source, row_number() OVER (PARTITION BY label ORDER BY {ORDER}) AS rn FROM g)
SELECT review_id, label, rating, source FROM o WHERE rn <= 100""")
def balanced_sample(spark, sf):
    rows = v.labelled(spark, sf).select("review_id", "label", "rating", "source")
    return splits.balanced_sample(rows, 300, "review_id")


TWO_WAY = f"""o AS (SELECT review_id, label, row_number() OVER (PARTITION BY label ORDER BY {ORDER}) AS rn,
  count(*) OVER (PARTITION BY label) AS n FROM e)"""


@query("e10_two_way_split", f"""WITH {v.EVENTS}, {TWO_WAY}
SELECT review_id, label, CASE WHEN rn <= round_even(n * 0.2::DOUBLE, 0) THEN 'held' ELSE 'kept' END AS split FROM o""")
def two_way_split(spark, sf):
    return splits.two_way(v.events(spark, sf).select("review_id", "label"), 0.2, "review_id")


@query("e10_two_way_by_user", f"""WITH {v.EVENTS}, o AS (SELECT review_id, text, row_number() OVER (PARTITION BY text ORDER BY {ORDER}) AS rn,
  count(*) OVER (PARTITION BY text) AS n, row_number() OVER (ORDER BY {ORDER}) AS rn_all, count(*) OVER () AS n_all FROM e),
  m AS (SELECT min(n) < 2 AS whole FROM o)
SELECT review_id, text, CASE WHEN CASE WHEN whole THEN rn_all <= round_even(n_all * 0.2::DOUBLE, 0) ELSE rn <= round_even(n * 0.2::DOUBLE, 0) END
  THEN 'held' ELSE 'kept' END AS split FROM o, m""")
def two_way_by_user(spark, sf):
    """Stratified by the user of an event: as many classes as there are users."""
    return splits.two_way(v.events(spark, sf).select("review_id", "text"), 0.2, "review_id", "text")


FOUR_WAY = f"""k AS (SELECT greatest(1, round_even(count(ts) * 0.2::DOUBLE, 0)::BIGINT) AS n FROM e),
  c AS (SELECT ts AS cutoff FROM (SELECT ts, row_number() OVER (ORDER BY ts DESC) AS rn FROM e), k WHERE rn = n),
  i AS (SELECT review_id, label, ts, row_number() OVER (PARTITION BY label ORDER BY {ORDER}) AS rn,
    round_even(count(*) OVER (PARTITION BY label) * 0.15::DOUBLE, 0) AS n_test,
    count(*) OVER (PARTITION BY label) AS n FROM e, c WHERE ts < cutoff),
  sp AS (SELECT review_id, label, ts, CASE WHEN rn <= n_test THEN 'test'
    WHEN rn <= n_test + round_even((n - n_test) * (0.15::DOUBLE / 0.85::DOUBLE), 0) THEN 'val' ELSE 'train' END AS split FROM i
    UNION ALL SELECT review_id, label, ts, 'oot' FROM e, c WHERE ts >= cutoff)"""


def four_way(spark, sf):
    return splits.train_val_test_oot(v.events(spark, sf).select("review_id", "label", "ts"), "review_id", "ts")


@query("e11_train_val_test_oot", f"WITH {v.EVENTS}, {FOUR_WAY} SELECT review_id, label, split FROM sp")
def train_val_test_oot(spark, sf):
    return four_way(spark, sf).frame.drop("ts")


@query("d14_split_summary", f"""WITH {v.EVENTS}, {FOUR_WAY}
SELECT split, count(*) AS n_rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last,
  (SELECT strftime(cutoff, '%Y-%m-%d %H:%M:%S.%f') FROM c) AS cutoff FROM sp GROUP BY split""")
def split_summary(spark, sf):
    out = splits.split_summary(four_way(spark, sf), "ts")
    return out.withColumns({c: v.stamp_text(c) for c in ("first", "last", "cutoff")})
