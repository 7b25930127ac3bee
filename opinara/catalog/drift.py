"""Drift scores, the promotion gate and the monitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.registry import query
from opinara.functions.labels import label_from_scores
from opinara.operators import drift, profiles
from opinara.operators.refine import monitoring_features
from opinara.session import scratch_path

SIDES = v.EVENTS + f""", x AS (SELECT *, ts >= TIMESTAMP '{v.SPLIT_DAY}' AS cur FROM e)"""


def psi_sql(columns: list[tuple[str, str, str]]) -> str:
    """Long-form counts and scores; each column is (name, role, bin expression)."""
    long = " UNION ALL ".join(
        f"SELECT '{name}' AS col, '{role}' AS role, ({expr})::VARCHAR AS bin, cur FROM x" for name, role, expr in columns
    )
    return f"""lf AS ({long}), cn AS (
  SELECT col, role, bin, count(*) FILTER (NOT cur) AS nr, count(*) FILTER (cur) AS nc FROM lf WHERE bin IS NOT NULL GROUP BY ALL),
  sh AS (SELECT col, role, greatest(nr::DOUBLE / sum(nr) OVER (PARTITION BY col), 0.0001::DOUBLE) AS r,
    greatest(nc::DOUBLE / sum(nc) OVER (PARTITION BY col), 0.0001::DOUBLE) AS c FROM cn),
  ps AS (SELECT col, role, sum((r - c) * ln(r / c)) AS psi FROM sh GROUP BY col, role)"""


VALUE_BIN = """least(floor((value - (SELECT min(value) FROM x)) / (((SELECT max(value) FROM x) - (SELECT min(value) FROM x)) /
  (SELECT ceil(log2(count(value))) + 1 FROM x))), (SELECT ceil(log2(count(value))) FROM x))"""
SOURCE, LABEL = ("source", "feature", "source"), ("label", "target", "label")
RATING, VALUE = ("rating", "feature", "rating"), ("value", "feature", VALUE_BIN)
PREDICTED = ("prediction", "prediction", v.threshold_sql(0.46))
PER_COLUMN = 'SELECT col AS "column", role, round(psi, 9) AS psi, psi > 0.25 AS drifted FROM ps'


def sides(spark, sf):
    e = v.events(spark, sf)
    split = F.lit(v.SPLIT_DAY).cast("timestamp")
    return e.where(F.col("ts") < split), e.where(F.col("ts") >= split)


def scored_sides(spark, sf):
    add = label_from_scores(v.event_scores())
    return tuple(df.withColumn("prediction", add) for df in sides(spark, sf))


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("k1_psi_categorical", f"WITH {SIDES}, {psi_sql([SOURCE])} {PER_COLUMN}")
def psi_categorical(spark, sf):
    ref, cur = sides(spark, sf)
    return rounded(drift.psi_by_column(ref, cur, [], ["source"], None), "psi")


@query("k2_psi_numeric", f"WITH {SIDES}, {psi_sql([VALUE, RATING])} {PER_COLUMN}")
def psi_numeric(spark, sf):
    ref, cur = sides(spark, sf)
    return rounded(drift.psi_by_column(ref, cur, ["value", "rating"], [], None), "psi")


@query("k3_psi_all_columns", f"WITH {SIDES}, {psi_sql([VALUE, RATING, SOURCE, LABEL, PREDICTED])} {PER_COLUMN}")
def psi_all_columns(spark, sf):
    ref, cur = scored_sides(spark, sf)
    out = drift.psi_by_column(ref, cur, ["value", "rating"], ["source"], prediction="prediction")
    return rounded(out, "psi")


# A reference of errors and views against a current of everything: the source mix drifts.
SHIFTED = v.EVENTS + """, x AS (SELECT *, false AS cur FROM e WHERE source IN ('error', 'view')
  UNION ALL SELECT *, true AS cur FROM e)"""
DRIFT_ROW = """SELECT count(*) FILTER (role = 'feature') AS n_features,
  count(*) FILTER (role = 'feature' AND psi > 0.25) AS n_drifted,
  coalesce(string_agg(col, ',' ORDER BY col) FILTER (role = 'feature' AND psi > 0.25), '') AS drifted_columns,
  round(max(psi) FILTER (role = 'target'), 9) AS target_drift_score,
  coalesce(bool_or(psi > 0.25) FILTER (role = 'target'), false) AS target_drift,
  round(max(psi) FILTER (role = 'prediction'), 9) AS prediction_drift_score,
  coalesce(bool_or(psi > 0.25) FILTER (role = 'prediction'), false) AS prediction_drift,
  round(coalesce(count(*) FILTER (role = 'feature' AND psi > 0.25)::DOUBLE / nullif(count(*) FILTER (role = 'feature'), 0), 0), 9) AS drift_score,
  (count(*) FILTER (role = 'feature' AND psi > 0.25) > 0) OR coalesce(bool_or(psi > 0.25) FILTER (role = 'target'), false) AS drift_blocks
FROM ps"""
ROUNDED = ["target_drift_score", "prediction_drift_score", "drift_score"]


def shifted_sides(spark, sf):
    e = v.events(spark, sf)
    return e.where(F.col("source").isin("error", "view")), e


@query("k4_drifted_share", f"""WITH {SHIFTED}, {psi_sql([VALUE, RATING, SOURCE])}, z AS ({DRIFT_ROW})
SELECT n_features, n_drifted, drifted_columns, drift_score FROM z""")
def drifted_share(spark, sf):
    ref, cur = shifted_sides(spark, sf)
    out = drift.drift_summary(drift.psi_by_column(ref, cur, ["value", "rating"], ["source"], None))
    return rounded(out.select("n_features", "n_drifted", "drifted_columns", "drift_score"), "drift_score")


@query("k5_target_drift", f"""WITH {SHIFTED}, {psi_sql([LABEL])}, z AS ({DRIFT_ROW}) SELECT target_drift_score, target_drift FROM z""")
def target_drift(spark, sf):
    ref, cur = shifted_sides(spark, sf)
    out = drift.drift_summary(drift.psi_by_column(ref, cur, [], []))
    return rounded(out.select("target_drift_score", "target_drift"), "target_drift_score")


@query("k6_prediction_drift", f"""WITH {SHIFTED}, {psi_sql([LABEL, PREDICTED])}, z AS ({DRIFT_ROW})
SELECT prediction_drift_score, prediction_drift FROM z""")
def prediction_drift(spark, sf):
    add = label_from_scores(v.event_scores())
    ref, cur = (df.withColumn("prediction", add) for df in shifted_sides(spark, sf))
    out = drift.drift_report(ref, cur, [], [])
    return rounded(out.select("prediction_drift_score", "prediction_drift"), "prediction_drift_score")


@query("k7_block_rule", f"WITH {SIDES}, {psi_sql([VALUE, RATING, SOURCE, LABEL])} {DRIFT_ROW}")
def block_rule(spark, sf):
    ref, cur = sides(spark, sf)
    out = drift.drift_summary(drift.psi_by_column(ref, cur, ["value", "rating"], ["source"]))
    return rounded(out, *ROUNDED)


def side_sql(name: str, where: str) -> str:
    return f"""{name}x AS (SELECT label, prediction FROM pred WHERE {where}),
  {name}c AS (SELECT s.label, (SELECT count(*) FROM {name}x WHERE label = s.label) AS support,
    (SELECT count(*) FROM {name}x WHERE prediction = s.label) AS predicted,
    (SELECT count(*) FROM {name}x WHERE label = s.label AND prediction = s.label) AS tp
    FROM (SELECT label FROM {name}x UNION SELECT prediction FROM {name}x) s),
  {name}m AS (SELECT avg(CASE WHEN predicted + support > 0 THEN (2 * tp)::DOUBLE / (predicted + support) ELSE 0 END) AS f1,
    max(tp::DOUBLE / support) FILTER (label = 'negative') AS rec FROM {name}c)"""


@query("k8_promotion_gate", f"""WITH {SIDES}, {psi_sql([VALUE, RATING, SOURCE, LABEL])}, z AS ({DRIFT_ROW}),
  pred AS (SELECT label, cur, {v.threshold_sql(0.46)} AS prediction FROM x), {side_sql("a", "NOT cur")}, {side_sql("b", "cur")}
SELECT z.*, round(am.f1, 9) AS reference_f1, round(bm.f1, 9) AS current_f1, round(am.rec, 9) AS reference_recall_neg,
  round(bm.rec, 9) AS current_recall_neg, round(am.f1 - bm.f1, 9) AS f1_drop, round(am.rec - bm.rec, 9) AS recall_neg_drop,
  am.f1 - bm.f1 > 0.03::DOUBLE AS f1_blocks, am.rec - bm.rec > 0.05::DOUBLE AS recall_neg_blocks,
  drift_blocks OR am.f1 - bm.f1 > 0.03::DOUBLE OR am.rec - bm.rec > 0.05::DOUBLE AS blocked_promotion FROM z, am, bm""")
def promotion_gate(spark, sf):
    ref, cur = scored_sides(spark, sf)
    out = drift.promotion_gate(ref, cur, numeric=["value", "rating"], categorical=["source"])
    return rounded(
        out, *ROUNDED, "reference_f1", "current_f1", "reference_recall_neg", "current_recall_neg", "f1_drop",
        "recall_neg_drop",
    )


MONITORED = v.EVENTS + """, x AS (
  SELECT length(text)::DOUBLE AS text_len, rating, source, label, false AS cur FROM e
  UNION ALL SELECT length(text)::DOUBLE, rating, source, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative'
    ELSE 'neutral' END, true FROM e WHERE review_date IN (SELECT DISTINCT review_date FROM e ORDER BY 1 DESC LIMIT 7))"""
BLOCKED = "drift_score > 0 OR target_drift OR prediction_drift AS blocked"


@query("k9_monitor", f"""WITH {MONITORED}, {psi_sql([("text_len", "feature", "text_len"), RATING, SOURCE, LABEL])}, z AS ({DRIFT_ROW})
SELECT *, {BLOCKED} FROM z""")
def monitor(spark, sf):
    e = v.events(spark, sf)
    return rounded(drift.monitor(e, e.drop("label")), *ROUNDED)


@query("k9_monitor_without_data", f"""WITH {v.EVENTS}, x AS (
  SELECT length(text)::DOUBLE AS text_len, rating, source, label, s.cur FROM e, (VALUES (false), (true)) s(cur)),
  {psi_sql([("text_len", "feature", "text_len"), RATING, SOURCE, LABEL])}, z AS ({DRIFT_ROW})
SELECT *, {BLOCKED} FROM z""")
def monitor_without_data(spark, sf):
    return rounded(drift.monitor(v.events(spark, sf), None), *ROUNDED)


@query("k10_scenario_monitor", f"""WITH {v.EVENTS}, x AS (
  SELECT label, false AS cur FROM e UNION ALL SELECT label, true FROM e WHERE review_date IN
    (SELECT DISTINCT review_date FROM e WHERE review_date <= '2024-01-10' ORDER BY 1 DESC LIMIT 2)),
  {psi_sql([LABEL])}, z AS ({DRIFT_ROW})
SELECT *, {BLOCKED} FROM z""")
def scenario_monitor(spark, sf):
    e = v.events(spark, sf)
    return rounded(drift.scenario_monitor(e, e, "2024-01-10", 2), *ROUNDED)


@query("g3_shared_columns", f"WITH {v.EVENTS} SELECT source, label, count(*) AS n_rows FROM e GROUP BY ALL")
def shared_columns(spark, sf):
    from opinara.schemas import shared_columns as shared

    ref, cur = sides(spark, sf)
    names = shared(ref.drop("value"), cur.drop("rating"), ["value", "rating", "source", "label"])
    both = ref.select(*names).unionByName(cur.select(*names))
    return both.groupBy(*names).agg(F.count("*").alias("n_rows"))


# ---------- stored profiles ----------

def stored_profiles(spark, sf):
    """Profiles of every date, written from half of the rows and again when the rest came."""
    root = scratch_path(spark, "profiles")
    e = v.events(spark, sf).withColumn("prediction", label_from_scores(v.event_scores()))
    for arrived in (e.where("id % 2 = 0"), e):
        profiles.write_profiles(arrived, root, numeric=["value", "rating"], categorical=["source", "label", "prediction"])
    return profiles.read_profiles(spark, root)


@query("k3_psi_from_profiles", f"WITH {SIDES}, {psi_sql([VALUE, RATING, SOURCE, LABEL, PREDICTED])} {PER_COLUMN}")
def psi_from_profiles(spark, sf):
    stored = stored_profiles(spark, sf)
    split = F.col("review_date") >= v.SPLIT_DAY
    roles = profiles.roles_of(["value", "rating"], ["source"], prediction="prediction")
    return rounded(profiles.psi_of_profiles(stored.where(~split), stored.where(split), roles), "psi")


BY_DAY = "WITH " + v.EVENTS + """, dd AS (SELECT DISTINCT review_date AS of_day FROM e),
x AS (SELECT e.*, of_day, e.review_date = of_day AS cur FROM e JOIN dd
  ON e.review_date::DATE BETWEEN of_day::DATE - INTERVAL 7 DAY AND of_day::DATE),
rg AS (SELECT of_day, min(value) AS lo, max(value) AS hi, ceil(log2(count(value))) + 1 AS k FROM x GROUP BY 1),
lf AS (SELECT x.of_day, 'value' AS col, 'feature' AS role, least(floor((value - lo) / ((hi - lo) / k)), k - 1)::VARCHAR AS bin, cur
    FROM x JOIN rg USING (of_day)
  UNION ALL SELECT of_day, 'rating', 'feature', rating::VARCHAR, cur FROM x
  UNION ALL SELECT of_day, 'source', 'feature', source, cur FROM x
  UNION ALL SELECT of_day, 'label', 'target', label, cur FROM x),
cn AS (SELECT of_day, col, role, bin, count(*) FILTER (NOT cur) AS nr, count(*) FILTER (cur) AS nc FROM lf GROUP BY ALL),
sh AS (SELECT of_day, col, role, greatest(nr::DOUBLE / sum(nr) OVER w, 0.0001::DOUBLE) AS r,
  greatest(nc::DOUBLE / sum(nc) OVER w, 0.0001::DOUBLE) AS c FROM cn WINDOW w AS (PARTITION BY of_day, col)),
ps AS (SELECT of_day, col, role, sum((r - c) * ln(r / c)) AS psi FROM sh GROUP BY ALL)
SELECT of_day AS review_date, col AS "column", role, round(psi, 9) AS psi, psi > 0.25 AS drifted FROM ps
WHERE of_day > (SELECT min(of_day) FROM dd)"""


@query("k3_psi_by_day", BY_DAY)
def psi_by_day(spark, sf):
    """Every date against the seven before it, all from one set of profiles."""
    return rounded(profiles.psi_by_day(stored_profiles(spark, sf), 7, profiles.roles_of(["value", "rating"], ["source"])), "psi")


@query("k2_profile_quantiles", "WITH " + v.EVENTS + """, p AS (SELECT unnest([0.0, 0.1, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS probability),
  o AS (SELECT 'value' AS col, value AS x FROM e UNION ALL SELECT 'rating', rating FROM e),
  r AS (SELECT col, x, row_number() OVER (PARTITION BY col ORDER BY x) AS k, count(*) OVER (PARTITION BY col) AS n FROM o)
SELECT col AS "column", probability, x AS value FROM r, p WHERE k = greatest(ceil(probability * n), 1)""")
def profile_quantiles(spark, sf):
    return profiles.profile_quantiles(stored_profiles(spark, sf), [0.0, 0.1, 0.5, 0.9, 0.99, 1.0])


@query("k9_monitor_from_profiles", f"""WITH {MONITORED}, {psi_sql([("text_len", "feature", "text_len"), RATING, SOURCE, LABEL])}, z AS ({DRIFT_ROW})
SELECT *, {BLOCKED} FROM z""")
def monitor_from_profiles(spark, sf):
    """K9 without its rows: the reference's profile against those of the newest dates."""
    e = v.events(spark, sf)
    reference, stored = scratch_path(spark, "reference-profile"), scratch_path(spark, "profiles")
    profiles.write_profiles(monitoring_features(e).withColumn("review_date", F.lit("reference")), reference)
    profiles.write_monitoring_profiles(e.drop("label"), stored)
    read = lambda root: profiles.read_profiles(spark, root)
    return rounded(profiles.monitor_profiles(read(reference), read(stored)), *ROUNDED)
