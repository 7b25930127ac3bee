"""Change points, gate intervals, thresholds and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.catalog import views as v
from opinara.catalog.drift import rounded, scored_sides
from opinara.catalog.registry import query
from opinara.operators import bootstrap, changes, thresholds

# From the 18th on, views are more often negative.
SHIFT = "p_negative >= 0.7::DOUBLE OR (source = 'view' AND review_date >= '2024-01-18' AND p_negative >= 0.45::DOUBLE)"


def shifted(spark, sf):
    negative = (F.col("p_negative") >= 0.7) | (
        (F.col("source") == "view") & (F.col("review_date") >= "2024-01-18") & (F.col("p_negative") >= 0.45)
    )
    return v.events(spark, sf).withColumn("label", F.when(negative, "negative").otherwise("positive"))


def change_sql(by: str) -> str:
    own = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    return f"""WITH {v.EVENTS}, s AS (
  SELECT {key}review_date AS day, count(*) AS n_rows, count(*) FILTER ({SHIFT}) * 100.0::DOUBLE / count(*) AS share FROM e GROUP BY ALL),
k AS (SELECT *, row_number() OVER ({own} ORDER BY day) AS k FROM s),
b AS (SELECT *, avg(share) FILTER (k <= 10) OVER ({own}) AS mu, stddev_pop(share) FILTER (k <= 10) OVER ({own}) AS sd FROM k),
z AS (SELECT *, (share - mu) / CASE WHEN sd > 0 THEN sd ELSE 1 END AS z FROM b),
p AS (SELECT *, sum(z - 0.5::DOUBLE) OVER w AS pu, sum(-z - 0.5::DOUBLE) OVER w AS pl FROM z WINDOW w AS ({own} ORDER BY day)),
c AS (SELECT *, pu - least(0, min(pu) OVER w) AS upper, pl - least(0, min(pl) OVER w) AS lower FROM p WINDOW w AS ({own} ORDER BY day)),
g AS (SELECT *, CASE WHEN upper >= 5 THEN 'up' WHEN lower >= 5 THEN 'down' END AS change FROM c),
o AS (SELECT *, CASE WHEN change = 'down' THEN lower ELSE upper END AS standing,
  coalesce(CASE WHEN change = 'down' THEN max(k) FILTER (lower <= 0) OVER w ELSE max(k) FILTER (upper <= 0) OVER w END, 0) + 1 AS first
  FROM g WINDOW w AS ({own} ORDER BY day))
SELECT {"o." + key if by else ""}o.day, o.n_rows, round(o.share, 6) AS share, round(o.upper, 6) AS upper, round(o.lower, 6) AS lower,
  coalesce(o.change, '') AS change, CASE WHEN o.standing > 0 THEN k.day ELSE '' END AS since
FROM o LEFT JOIN k ON k.k = o.first {f"AND k.{by} = o.{by}" if by else ""}"""


def change_rows(spark, sf, by):
    out = changes.change_points(changes.daily_share(shifted(spark, sf), by=by), 10, by=by)
    return out.withColumns({
        **{c: F.round(c, 6) for c in ("share", "upper", "lower")},
        **{c: F.coalesce(c, F.lit("")) for c in ("change", "since")},
    })


@query("k12_change_points", change_sql(""))
def change_points(spark, sf):
    return change_rows(spark, sf, [])


@query("k12_change_points_by_brand", change_sql("source"))
def change_points_by_brand(spark, sf):
    """A series per brand; one of them rises in the third week."""
    return change_rows(spark, sf, ["source"])


CUTS = "[" + ", ".join(map(str, bootstrap.poisson_cuts())) + "]"


def bootstrap_sql(rows: str) -> str:
    """Weighted metrics per side and replicate of ``rows`` (review_id, label, prediction, cur)."""
    return f"""rp AS (SELECT unnest(range(64)) AS replicate),
w0 AS (SELECT r.*, replicate, sha256(concat('42|', replicate // 16, '|', review_id)) AS h FROM ({rows}) r, rp),
w AS (SELECT *, len(list_filter({CUTS}, lambda c: c <= ('0x' || substr(h, (replicate % 16 * 4 + 1)::INTEGER, 4))::INTEGER)) AS weight FROM w0),
cl AS (SELECT cur, replicate, class, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
  SELECT cur, replicate, label AS class, weight AS support, 0 AS predicted, CASE WHEN label = prediction THEN weight ELSE 0 END AS tp FROM w WHERE weight > 0
  UNION ALL SELECT cur, replicate, prediction, 0, weight, 0 FROM w WHERE weight > 0) GROUP BY ALL),
mt AS (SELECT cur, replicate, avg(2 * tp::DOUBLE / (support + predicted)) AS f1_macro,
  max(tp::DOUBLE / nullif(support, 0)) FILTER (class = 'negative') AS recall_neg FROM cl GROUP BY ALL)"""


PREDICTED = f"SELECT review_id, label, {v.threshold_sql(0.46)} AS prediction, ts >= TIMESTAMP '{v.SPLIT_DAY}' AS cur FROM e"


@query("k8_replicate_metrics", f"""WITH {v.EVENTS}, {bootstrap_sql(PREDICTED)}
SELECT cur, replicate::INTEGER AS replicate, round(f1_macro, 9) AS f1_macro, round(recall_neg, 9) AS recall_neg FROM mt""")
def replicate_metrics(spark, sf):
    old, new = scored_sides(spark, sf)
    both = old.withColumn("cur", F.lit(False)).unionByName(new.withColumn("cur", F.lit(True)))
    return rounded(bootstrap.replicate_metrics(both, "review_id", ["cur"]), "f1_macro", "recall_neg")


@query("k8_gate_interval", f"""WITH {v.EVENTS}, {bootstrap_sql(PREDICTED)},
dr AS (SELECT unnest([{{'metric': 'f1_drop', 'value': a.f1_macro - b.f1_macro, 'limit': 0.03::DOUBLE}},
  {{'metric': 'recall_neg_drop', 'value': a.recall_neg - b.recall_neg, 'limit': 0.05::DOUBLE}}], recursive := true)
  FROM mt a JOIN mt b ON a.replicate = b.replicate AND NOT a.cur AND b.cur),
so AS (SELECT metric, any_value("limit") AS "limit", list_sort(list(value)) AS x FROM dr GROUP BY metric),
iv AS (SELECT metric, x[greatest(ceil(len(x) * ((1 - 0.95::DOUBLE) / 2)), 1)::INTEGER] AS low, x[greatest(ceil(len(x) * 0.5::DOUBLE), 1)::INTEGER] AS middle,
  x[greatest(ceil(len(x) * (1 - (1 - 0.95::DOUBLE) / 2)), 1)::INTEGER] AS high, "limit" FROM so)
SELECT metric, round(low, 9) AS low, round(middle, 9) AS middle, round(high, 9) AS high, "limit",
  CASE WHEN low > "limit" THEN 'blocked' WHEN high <= "limit" THEN 'passed' ELSE 'unsure' END AS verdict FROM iv""")
def gate_interval(spark, sf):
    return rounded(bootstrap.gate_interval(*scored_sides(spark, sf), "review_id"), "low", "middle", "high")


# Truth that a score tells in part: the likelier, the more often negative.
TRUTH = "(id * 31 % 997)::DOUBLE / 997.0::DOUBLE < p_negative * p_negative"
COUNTED = f"""{v.EVENTS}, n AS (SELECT greatest(least(floor(p_negative * 200)::BIGINT, 199), 0) AS bin, count(*) AS n,
  count(*) FILTER ({TRUTH}) AS n_positive FROM e GROUP BY 1)"""
CURVE = COUNTED + """, cv AS (SELECT bin / 200.0::DOUBLE AS threshold, (sum(n) OVER w)::BIGINT AS n_predicted, (sum(n_positive) OVER w)::BIGINT AS n_hit,
  (SELECT sum(n_positive) FROM n)::BIGINT AS pos FROM n WINDOW w AS (ORDER BY bin DESC)),
  pr AS (SELECT threshold, n_predicted, n_hit, n_hit::DOUBLE / n_predicted AS precision, n_hit::DOUBLE / nullif(pos, 0) AS recall,
  2 * n_hit::DOUBLE / (n_predicted + pos) AS f1 FROM cv)"""
CURVE_ROW = "threshold, n_predicted, n_hit, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1"


def scored_truth(spark, sf):
    told = (F.col("id") * 31 % 997) / F.lit(997.0) < F.col("p_negative") * F.col("p_negative")
    return v.events(spark, sf).withColumn("truth", told)


def curve_of(spark, sf):
    return thresholds.precision_recall(thresholds.score_bins(scored_truth(spark, sf), "p_negative", "truth", 200), 200)


@query("h13_precision_recall", f"WITH {CURVE} SELECT {CURVE_ROW} FROM pr")
def precision_recall(spark, sf):
    return rounded(curve_of(spark, sf), "precision", "recall", "f1")


@query("h13_chosen_threshold", f"""WITH {CURVE}
(SELECT 'f1' AS goal, {CURVE_ROW} FROM pr ORDER BY pr.f1 DESC, threshold DESC LIMIT 1) UNION ALL
(SELECT 'recall' AS goal, {CURVE_ROW} FROM pr WHERE pr.recall >= 0.9 ORDER BY pr.precision DESC, threshold DESC LIMIT 1)""")
def chosen_threshold(spark, sf):
    """The best F1, and the best precision that keeps nine tenths of the negatives."""
    curve = curve_of(spark, sf)
    both = thresholds.choose_threshold(curve).withColumn("goal", F.lit("f1")).unionByName(
        thresholds.choose_threshold(curve, 0.9).withColumn("goal", F.lit("recall"))
    )
    return rounded(both, "precision", "recall", "f1")


@query("m6_calibrated_scores", f"""WITH {COUNTED},
cs AS (SELECT bin, sum(n) OVER w AS cn, sum(n_positive) OVER w AS cp, n, n_positive FROM n WINDOW w AS (ORDER BY bin)),
means AS (SELECT s.bin AS s, u.bin AS u, (u.cp - s.cp + s.n_positive)::DOUBLE / (u.cn - s.cn + s.n) AS m FROM cs s JOIN cs u ON s.bin <= u.bin),
least_mean AS (SELECT t.bin AS t, s, min(m) AS m FROM n t JOIN means ON s <= t.bin AND u >= t.bin GROUP BY ALL),
iso AS (SELECT t AS bin, max(m) AS probability FROM least_mean GROUP BY t)
SELECT review_id, round(probability, 9) AS calibrated FROM e JOIN iso ON greatest(least(floor(p_negative * 200)::BIGINT, 199), 0) = bin""")
def calibrated_scores(spark, sf):
    """Every score with its calibrated probability; the SQL has the minimax form of the same steps."""
    rows = scored_truth(spark, sf)
    steps = thresholds.isotonic(thresholds.score_bins(rows, "p_negative", "truth", 200))
    return rounded(thresholds.calibrate(rows, steps, "p_negative", bins=200).select("review_id", "calibrated"), "calibrated")
