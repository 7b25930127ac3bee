"""Timelines, tiles, words, model comparison, run history, recent windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions.labels import PRODUCTION_TAU, STAGING_TAU
from opinara.operators import analytics, metrics, quality, windows
from opinara.schemas import REVIEWS
from opinara.sources import tables


def pct_sql(label: str) -> str:
    return f"round(100.0::DOUBLE * count(*) FILTER (label = '{label}') / count(*), 9)"


PCTS = ", ".join(f"{pct_sql(lb)} AS pct_{lb}" for lb in ("positive", "negative", "neutral"))


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


# ---------- aggregations ----------

def timeline(spark, sf, freq):
    out = analytics.sentiment_timeline(v.events(spark, sf), freq, "ts")
    return rounded(out.withColumn("period", v.day_text("period")), "pct_positive", "pct_negative", "pct_neutral")


@query("d1_timeline_day", f"""WITH {v.EVENTS}
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, count(*) AS n_reviews, {PCTS} FROM e GROUP BY 1""")
def timeline_day(spark, sf):
    return timeline(spark, sf, "D")


@query("d1_timeline_week", f"""WITH {v.EVENTS}
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS period, count(*) AS n_reviews, {PCTS} FROM e GROUP BY 1""")
def timeline_week(spark, sf):
    return timeline(spark, sf, "W")


@query("d2_daily_negative_share", f"""WITH {v.EVENTS}
SELECT review_date, count(*) AS n_rows, round(avg(CASE WHEN label = 'negative' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9)
  AS negative_share FROM e GROUP BY 1""")
def daily_negative_share(spark, sf):
    return rounded(analytics.daily_negative_share(v.events(spark, sf)), "negative_share")


@query("d3_stream_summary", f"""WITH {v.EVENTS}, w AS (
  SELECT review_date, count(*) AS n, count(*) FILTER (label = 'negative')::DOUBLE / count(*) AS share FROM e GROUP BY 1)
SELECT count(*) AS n_rows, min(review_date) AS first_date, max(review_date) AS last_date,
  count(*) FILTER (label = 'negative') AS n_negative, count(*) FILTER (label = 'neutral') AS n_neutral,
  count(*) FILTER (label = 'positive') AS n_positive,
  (SELECT review_date FROM w ORDER BY share DESC, review_date LIMIT 1) AS peak_day,
  round((SELECT max(share) FROM w), 9) AS peak_share FROM e""")
def stream_summary(spark, sf):
    return rounded(analytics.stream_summary(v.events(spark, sf)), "peak_share")


LAST_DAY = "(SELECT date_trunc('day', max(ts)) FROM e)"


def batch_pct(label: str) -> str:
    return f"round_even(100.0::DOUBLE * count(*) FILTER (label = '{label}') / count(*), 1) AS pct_{label}"


@query("d4_kpi_tiles", f"""WITH {v.EVENTS}, t AS (SELECT count(*) AS batch_size, (SELECT count(*) FROM e) AS window_size,
  {batch_pct("positive")}, {batch_pct("negative")}, {batch_pct("neutral")} FROM e WHERE ts >= {LAST_DAY})
SELECT *, round_even(pct_positive / 100 * batch_size, 0)::BIGINT AS n_positive,
  round_even(pct_neutral / 100 * batch_size, 0)::BIGINT AS n_neutral,
  CASE WHEN pct_negative >= 25 THEN 'above threshold' ELSE 'normal' END AS status FROM t""")
def kpi_tiles(spark, sf):
    return analytics.kpi_tiles(v.events(spark, sf), "ts")


@query("d5_latest_batch", f"WITH {v.EVENTS} SELECT id, label, source FROM e WHERE ts >= {LAST_DAY}")
def latest_batch(spark, sf):
    return windows.latest_batch(v.events(spark, sf), "ts").select("id", "label", "source")


@query("d6_label_distribution", f"""WITH {v.EVENTS}
SELECT label, count(*) AS n_rows, round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM e), 1) AS pct FROM e GROUP BY 1""")
def label_distribution(spark, sf):
    return analytics.label_distribution(v.events(spark, sf))


# The words left out, as a literal of the SQL side's own.
STOPWORDS = """
the a an and or but if to of in on at
for with as by from into onto upon about
above below between around through during before
after over under again further then once off
out than so yet both either neither nor

i me my we us our you your they them
their he she his her it its this that
these those who which what where when why how

is are was were be been being am
have has had do does did
will would could should can may might shall
not no nor

wasn't weren't don't doesn't didn't isn't aren't
it's i'm you're they're we're he's she's that's
i've you've they've we've won't can't couldn't
wouldn't shouldn't hadn't hasn't haven't i'd you'd
they'd we'd he'd she'd i'll you'll they'll we'll

very just only also really too here there
still even much more most some any all
many few such own same other another each
every both more most quite rather always never
ever already now back away else well

said say told tell came come going went go
get got gotten getting give gave given giving
take took taken taking put putting ask asked
asking know knew known want wanted wanting
left leave leaving make made making see saw
seen seeing try tried trying look looked looking
think thought thinking need needed use used using
seem seemed call called calling let keep kept
bring brought drive drove driven start started

because while although though unless until since
however therefore instead otherwise meanwhile

like one two place good people first done
location restaurant drinks waited customers times
way waiting something store nothing orders
years day great customer
"""


def words_sql(tail: str) -> str:
    drop = v.list_sql(sorted(set(STOPWORDS.split())))
    return f"""WITH {v.LABELLED}, t AS (
  SELECT unnest(regexp_extract_all(lower(text), '[A-Za-z][A-Za-z'']{{2,}}')) AS word FROM g WHERE label = 'negative'),
  wc AS (SELECT word, count(*) AS n FROM t WHERE word NOT IN ({drop}) GROUP BY word) SELECT word, n FROM wc {tail}"""


@query("d7_negative_words", lambda: words_sql(""))
def negative_words(spark, sf):
    return analytics.negative_word_counts(v.labelled(spark, sf), None)


@query("f2_top_negative_words", lambda: words_sql("ORDER BY n DESC, word LIMIT 17"))
def top_negative_words(spark, sf):
    return analytics.negative_word_counts(v.labelled(spark, sf), 17)


PAIRS = v.PREDICTIONS + """, pr AS (
  SELECT text, arg_max(predicted_label, (predicted_at, id)) FILTER (stage = 'Production') AS production_label,
    arg_max(predicted_label, (predicted_at, id)) FILTER (stage = 'Staging') AS staging_label FROM p GROUP BY text)"""


@query("e6_last_label_per_stage", f"""WITH {PAIRS}
SELECT lower(sha256(text)) AS text_key, production_label, staging_label FROM pr""")
def last_label_per_stage(spark, sf):
    out = analytics.last_label_per_stage(v.predictions(spark, sf))
    return out.withColumn("text_key", F.lower(F.hex("text_key")))


PAIRED = PAIRS + ", paired AS (SELECT * FROM pr WHERE production_label IS NOT NULL AND staging_label IS NOT NULL)"


@query("c6_paired_predictions", f"WITH {PAIRED} SELECT lower(sha256(text)) AS text_key, production_label, staging_label FROM paired")
def paired_predictions(spark, sf):
    out = analytics.paired_predictions(v.predictions(spark, sf))
    return out.withColumn("text_key", F.lower(F.hex("text_key")))


def side_counts(column: str, short: str) -> str:
    return ", ".join(
        f"count(*) FILTER ({column} = '{lb}') AS {short}_{lb}" for lb in ("negative", "neutral", "positive")
    )


@query("d8_shadow_agreement", f"""WITH {PAIRED}
SELECT count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (production_label = staging_label) / count(*), 9) AS agree_pct,
  {side_counts("production_label", "prod")}, {side_counts("staging_label", "stag")} FROM paired""")
def shadow_agreement(spark, sf):
    pairs = analytics.paired_predictions(v.predictions(spark, sf))
    return rounded(analytics.shadow_agreement(pairs), "agree_pct")


@query("d9_negative_volume", f"""WITH {v.PREDICTIONS}, q AS (
  SELECT predicted_at::DATE AS d, count(*) FILTER (stage = 'Production') AS "Production",
    count(*) FILTER (stage = 'Staging') AS "Staging" FROM
    (SELECT * REPLACE (predicted_at + CASE WHEN dayofweek(predicted_at) = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS predicted_at) FROM p)
  WHERE predicted_label = 'negative' AND predicted_at >= TIMESTAMP '{v.NOW}' - INTERVAL 14 DAY GROUP BY 1),
  c AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM q)
SELECT strftime(c.d, '%Y-%m-%d') AS period, coalesce("Production", 0) AS "Production", coalesce("Staging", 0) AS "Staging"
FROM c LEFT JOIN q USING (d)""")
def negative_volume(spark, sf):
    """Sundays' predictions come on Mondays, so there are days without any."""
    late = F.col("predicted_at") + F.expr("INTERVAL 1 DAY")
    moved = F.when(F.dayofweek("predicted_at") == 1, late).otherwise(F.col("predicted_at"))
    weekdays = v.predictions(spark, sf).withColumn("predicted_at", moved)
    return analytics.negative_volume(weekdays, v.NOW).withColumn("period", v.day_text("period"))


@query("d10_run_summary", f"""WITH {v.SILVER}, t AS (
  SELECT date AS review_date, count(*) AS n_rows FROM s WHERE date IN (SELECT DISTINCT date FROM s ORDER BY date DESC LIMIT 30) GROUP BY 1)
SELECT * FROM t UNION ALL SELECT 'total', sum(n_rows)::BIGINT FROM t""")
def run_summary(spark, sf):
    rows = v.silver(spark, sf).withColumn("review_date", F.col("date"))
    return analytics.run_summary(rows, windows.recent_keys(rows, 30))


@query("d11_table_count", f"WITH {v.SILVER} SELECT count(*) AS n_rows FROM s")
def table_count(spark, sf):
    return tables.row_count(v.silver(spark, sf))


CONFUSION = v.EVENTS + f""", x AS (SELECT label, {v.threshold_sql(PRODUCTION_TAU)} AS prediction FROM e),
  seen AS (SELECT label FROM x UNION SELECT prediction FROM x), pc AS (
  SELECT s.label, (SELECT count(*) FROM x WHERE x.label = s.label) AS support,
    (SELECT count(*) FROM x WHERE x.prediction = s.label) AS predicted,
    (SELECT count(*) FROM x WHERE x.label = s.label AND x.prediction = s.label) AS tp FROM seen s),
  cl AS (SELECT *, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS "precision",
    CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS recall,
    CASE WHEN predicted + support > 0 THEN (2 * tp)::DOUBLE / (predicted + support) ELSE 0 END AS f1 FROM pc)"""
METRICS = """SELECT sum(support)::BIGINT AS n_rows, round(sum(tp)::DOUBLE / sum(support), 9) AS accuracy, round(avg(f1), 9) AS f1_macro,
  round(sum(f1 * support) / sum(support), 9) AS f1_weighted, round(max(f1) FILTER (label = 'negative'), 9) AS f1_neg,
  round(max("precision") FILTER (label = 'negative'), 9) AS precision_neg,
  round(max(recall) FILTER (label = 'negative'), 9) AS recall_neg FROM cl"""
METRIC_COLUMNS = ["accuracy", "f1_macro", "f1_weighted", "f1_neg", "precision_neg", "recall_neg"]


def judged(spark, sf, tau=PRODUCTION_TAU):
    from opinara.functions.labels import label_from_scores

    return v.events(spark, sf).withColumn("prediction", label_from_scores(v.event_scores(), tau))


@query("d12_per_class_metrics", f"""WITH {CONFUSION}
SELECT label, support, predicted, tp, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1 FROM cl""")
def per_class_metrics(spark, sf):
    return rounded(metrics.per_class(metrics.confusion(judged(spark, sf))), "precision", "recall", "f1")


@query("d12_metric_summary", f"WITH {CONFUSION} {METRICS}")
def metric_summary(spark, sf):
    return rounded(metrics.summary(judged(spark, sf)), *METRIC_COLUMNS)


@query("d13_f1_and_negative_recall", f"WITH {CONFUSION}, z AS ({METRICS}) SELECT f1_macro, recall_neg FROM z")
def f1_and_negative_recall(spark, sf):
    return rounded(metrics.summary(judged(spark, sf)).select("f1_macro", "recall_neg"), "f1_macro", "recall_neg")


@query("k11_quality_gate", f"WITH {CONFUSION}, z AS ({METRICS}) SELECT f1_macro, f1_macro >= 0.5 AS promote FROM z")
def quality_gate(spark, sf):
    gate = metrics.quality_gate(metrics.summary(judged(spark, sf)))
    return rounded(gate.select("f1_macro", "promote"), "f1_macro")


@query("d15_duplicate_rate", f"""WITH {v.SILVER}, q AS (
  SELECT count(*) AS n_rows, count(DISTINCT (source, source_id)) AS n_keys FROM s)
SELECT n_rows, n_keys, round(1.0::DOUBLE - n_keys::DOUBLE / n_rows, 9) AS duplicate_rate,
  1.0::DOUBLE - n_keys::DOUBLE / n_rows < 0.01 AS success FROM q""")
def duplicate_rate(spark, sf):
    return rounded(quality.duplicate_rate(v.silver(spark, sf), ["source", "source_id"]), "duplicate_rate")


# ---------- run history ----------

HISTORY = v.REPORTS + """, o AS (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY created_at DESC) AS rn
  FROM m WHERE report_type = 'data_drift')"""


@query("e4_drift_history", f"""WITH {HISTORY}
SELECT run_date, drift_score, blocked_promotion FROM o WHERE rn = 1 ORDER BY run_date DESC LIMIT 21""")
def drift_history(spark, sf):
    return analytics.drift_history(v.reports(spark, sf))


@query("e5_latest_report", f"""WITH {v.REPORTS}
SELECT report_url, drift_score, blocked_promotion, run_date FROM m ORDER BY created_at DESC LIMIT 1""")
def latest_report(spark, sf):
    return analytics.latest_report(v.reports(spark, sf))


@query("e7_metric_delta", f"""WITH {v.EVENTS}, o AS (
  SELECT text, p_negative, lag(p_negative) OVER (PARTITION BY text ORDER BY id) AS previous,
    row_number() OVER (PARTITION BY text ORDER BY id DESC) AS rn FROM e)
SELECT text AS model, p_negative AS last, previous, round(p_negative - previous, 9) AS delta FROM o WHERE rn = 1 AND previous IS NOT NULL""")
def metric_delta(spark, sf):
    runs = v.events(spark, sf).select(
        F.col("text").alias("model"), F.col("id").alias("x_ord"), F.col("p_negative").alias("f1_neg")
    )
    return rounded(analytics.metric_delta(runs), "delta")


@query("e8_leaderboard", f"""WITH {v.EVENTS}, a AS (
  SELECT text AS run_id, id AS version, CASE source WHEN 'purchase' THEN 'production' WHEN 'signup' THEN 'staging'
    WHEN 'click' THEN 'canary' ELSE 'archived' END AS status,
    CASE WHEN id % 2 = 0 THEN p_negative WHEN id % 3 = 0 THEN p_neutral END AS f1_neg FROM e),
  k AS (SELECT *, CASE status WHEN 'production' THEN 0 WHEN 'staging' THEN 1 WHEN 'archived' THEN 2 ELSE 9 END AS stage_order FROM a),
  o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY stage_order, version DESC) AS rn FROM k)
SELECT run_id, version, status, f1_neg FROM o WHERE rn = 1""")
def leaderboard(spark, sf):
    kind = F.col("source")
    stage = (
        F.when(kind == "purchase", "Production").when(kind == "signup", "Staging").when(kind == "click", "canary")
        .when(kind == "view", "None")
    )
    versions = v.events(spark, sf).select(
        F.col("text").alias("run_id"), F.col("id").alias("version"), stage.alias("stage"),
        F.when(F.col("id") % 2 == 0, F.col("p_negative")).alias("f1_neg"),
        F.when(F.col("id") % 3 == 0, F.col("p_neutral")).alias("test_f1_negative"),
    )
    named = analytics.metric_alias(versions, "f1_neg", "test_f1_negative", "f1_negative")
    return analytics.leaderboard(named).select("run_id", "version", "status", "f1_neg")


# ---------- top rows ----------

@query("f1_newest_negatives", f"""WITH {v.EVENTS}
SELECT review_id, text AS snippet, upper(source[1]) || source[2:] AS source, strftime(ts, '%d %b %Y') AS day
FROM e WHERE label = 'negative' ORDER BY ts DESC, review_id LIMIT 4""")
def newest_negatives(spark, sf):
    return analytics.newest_negatives(v.events(spark, sf), 4, "ts")


@query("f4_time_order", f"""WITH {v.EVENTS}
SELECT review_date, review_id, label FROM e ORDER BY review_date, review_id""")
def time_order(spark, sf):
    return analytics.time_order(v.events(spark, sf).select("review_date", "review_id", "label"))


# ---------- recent windows ----------

@query("a10_partition_inventory", f"""WITH {v.EVENTS}
SELECT CASE WHEN source = 'view' THEN '__null__' ELSE review_date END AS review_date, count(*) AS n_rows FROM e GROUP BY 1""")
def partition_inventory(spark, sf):
    key = F.when(F.col("source") == "view", "__null__").otherwise(F.col("review_date"))
    return windows.partition_counts(v.events(spark, sf).withColumn("review_date", key))


@query("a11_layer_reconciliation", f"""WITH {v.LABELLED}, a AS (
  SELECT CASE WHEN review_date >= '2024-06-01' THEN 'late' ELSE review_date END AS review_date, count(*) AS n FROM f GROUP BY 1),
  b2 AS (SELECT CASE WHEN review_date < '2021-06-01' THEN 'early' ELSE review_date END AS review_date, count(*) AS n FROM ls GROUP BY 1)
SELECT review_date, coalesce(a.n, 0) AS n_features, coalesce(b2.n, 0) AS n_labels FROM a FULL JOIN b2 USING (review_date)""")
def layer_reconciliation(spark, sf):
    """All rows of both stores; some dates of either go by another name on the other side."""
    late = F.when(F.col("review_date") >= "2024-06-01", "late").otherwise(F.col("review_date"))
    early = F.when(F.col("review_date") < "2021-06-01", "early").otherwise(F.col("review_date"))
    return windows.reconcile(
        v.features(spark, sf).withColumn("review_date", late), v.label_rows(spark, sf).withColumn("review_date", early)
    )


@query("a13_recent_partitions", f"""WITH {v.EVENTS}
SELECT id, review_date FROM e WHERE review_date IN (SELECT DISTINCT review_date FROM e ORDER BY 1 DESC LIMIT 7)""")
def recent_partitions(spark, sf):
    return windows.recent_partitions(v.events(spark, sf), 7).select("id", "review_date")


@query("a14_replay_window", f"""WITH {v.EVENTS}
SELECT id, review_date FROM e WHERE review_date IN
  (SELECT DISTINCT review_date FROM e WHERE review_date <= '2024-01-20' ORDER BY 1 DESC LIMIT 5)""")
def replay_window(spark, sf):
    return windows.replay_window(v.events(spark, sf), "2024-01-20", 5).select("id", "review_date")


GOLD_WINDOW = """w AS (SELECT f.review_id, f.review_date, f.text, ls.label FROM f JOIN ls USING (review_id)
  WHERE f.review_date >= strftime((SELECT max(review_date)::DATE FROM f) - INTERVAL {days} DAY, '%Y-%m-%d')
    AND f.review_date IN (SELECT review_date FROM ls))"""


@query("a15_gold_window", f"WITH {v.LABELLED}, {GOLD_WINDOW.format(days=364)} SELECT review_id, review_date, text, label FROM w")
def gold_window(spark, sf):
    return windows.gold_window(v.features(spark, sf), v.label_rows(spark, sf), 365)


@query("c5_gold_window_labels", f"""WITH {v.LABELLED}, {GOLD_WINDOW.format(days=999)}
SELECT label, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars FROM w GROUP BY label""")
def gold_window_labels(spark, sf):
    joined = windows.gold_window(v.features(spark, sf), v.label_rows(spark, sf), 1000)
    return joined.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


def reviews_table(spark, sf):
    return v.events(spark, sf).select("text", "label", "source", F.col("ts").alias("ingested_at"))


@query("a16_load_reviews", f"""WITH {v.LABELLED}, {GOLD_WINDOW.format(days=13)}
SELECT text, label, review_date FROM w""")
def load_reviews(spark, sf):
    stale = reviews_table(spark, sf)
    out = windows.load_reviews(
        stale, (v.features(spark, sf), v.label_rows(spark, sf)), None, now="2026-06-30 00:00:00", days=14
    )
    return out.withColumn("review_date", v.day_text("review_date"))


@query("a16_load_reviews_file", f"""WITH {v.EVENTS}
SELECT text, label, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS review_date FROM e WHERE ts >= (SELECT max(ts) FROM e) - INTERVAL 14 DAY""")
def load_reviews_file(spark, sf):
    file = v.events(spark, sf).select("text", "label", v.stamp_text("ts").alias("date"))
    out = windows.load_reviews(None, None, file, now=v.NOW, days=14)
    return out.withColumn("review_date", v.stamp_text("review_date"))


@query("a17_reviews_since", f"""WITH {v.EVENTS}
SELECT text, label, source, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at FROM e
WHERE ts >= TIMESTAMP '{v.NOW}' - INTERVAL 7 DAY""")
def reviews_since(spark, sf):
    out = windows.reviews_since(reviews_table(spark, sf), v.NOW, 7)
    return out.withColumn("ingested_at", v.stamp_text("ingested_at"))


# ---------- table writes as row sets ----------

@query("a21_nulls_for_nan", f"""WITH {v.EVENTS}
SELECT id, CASE WHEN source <> 'view' THEN value END AS value, NULL::VARCHAR AS note FROM e""")
def nulls_for_nan(spark, sf):
    nan = F.when(F.col("source") == "view", F.lit(float("nan"))).otherwise(F.col("value"))
    return tables.nulls_for_nan(v.events(spark, sf).withColumn("value", nan), ["id", "value", "note"])


@query("a24_append_scored", f"""WITH {v.LABELLED}
SELECT text, 'neutral' AS label, source, date AS day FROM d
UNION ALL SELECT substr(text, 1, 10000), label, 'batch', '2026-06-06' FROM g
  WHERE regexp_matches(text, '{v.SQL_NON_SPACE}')""")
def append_scored(spark, sf):
    d = v.documents(spark, sf)
    existing = d.select("text", F.lit("neutral").alias("label"), "source", F.col("date").cast("timestamp").alias("ingested_at"))
    scored = v.labelled(spark, sf).select(
        "text", "label", F.lit("batch").alias("source"), F.lit("2026-06-06").cast("timestamp").alias("ingested_at")
    )
    out = tables.append_scored(existing.select(*[f.name for f in REVIEWS]), scored)
    return out.withColumn("day", v.day_text("ingested_at")).drop("ingested_at")


@query("a25_replace_recent", f"""WITH {v.EVENTS}, x AS (
  SELECT text, label, source, ts FROM e WHERE ts < TIMESTAMP '{v.NOW}' - INTERVAL 3 DAY
  UNION ALL SELECT text, label, 'batch', TIMESTAMP '{v.NOW}' FROM e WHERE ts >= TIMESTAMP '{v.NOW}' - INTERVAL 3 DAY)
SELECT text, label, source, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at FROM x""")
def replace_recent(spark, sf):
    old = reviews_table(spark, sf)
    fresh = windows.reviews_since(old, v.NOW, 3, ordered=False).withColumns({
        "source": F.lit("batch"), "ingested_at": F.lit(v.NOW).cast("timestamp"),
    })
    out = tables.replace_recent(old, fresh, v.NOW, 3)
    return out.withColumn("ingested_at", v.stamp_text("ingested_at"))


@query("a26_append_report", f"""WITH {v.REPORTS}
SELECT run_date, report_type, report_url, drift_score, blocked_promotion FROM m
UNION ALL SELECT '2024-01-31', 'data_drift', 's3://monitoring/2024-01-31/data_drift.html', 0.25::DOUBLE, true""")
def append_report(spark, sf):
    out = tables.append_report(
        v.reports(spark, sf), "2024-01-31", "data_drift", "s3://monitoring/2024-01-31/data_drift.html", 0.25, True, v.NOW
    )
    return out.drop("created_at")


# ---------- alerts and shadow scores ----------

@query("k12_spike_alert", f"""WITH {v.EVENTS}, t AS (
  SELECT count(*) AS batch_size, {batch_pct("negative")} FROM e WHERE ts >= {LAST_DAY})
SELECT *, pct_negative >= 25 AS alert FROM t""")
def spike_alert(spark, sf):
    return analytics.spike_alert(v.events(spark, sf), "ts")


@query("m6_shadow_scoring", f"""WITH {v.EVENTS}
SELECT id, {v.threshold_sql(PRODUCTION_TAU)} AS production_label, {v.threshold_sql(STAGING_TAU)} AS staging_label,
  'shadow' AS stage FROM e""")
def shadow_scoring(spark, sf):
    from opinara.operators.model import shadow_score

    return shadow_score(v.events(spark, sf), v.event_scores(), ["id"])
