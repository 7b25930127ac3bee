import math
import re
from collections import Counter

from pyspark.sql import functions as F

from opinara.operators import languages

SAID = {
    "en": ["the food was very good and the staff were kind", "we waited for the bill with our friends", "this is what they said about that"],
    "de": ["das Essen war sehr gut und die Bedienung freundlich", "wir haben lange auf die Rechnung gewartet", "nicht schlecht, aber teuer für Öl"],
    "es": ["la comida estaba muy buena y el servicio también", "esperamos mucho por la cuenta", "el camarero no sabía qué decir"],
}
ROWS = [(k, text, lang) for k, (lang, text) in enumerate((lang, t) for lang, ts in SAID.items() for t in ts)]


def grams(text):
    return [f" {w} "[k : k + 3] for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for k in range(len(w))]


def test_profile_and_scores_by_hand(spark):
    df = spark.createDataFrame([*ROWS, (90, "the unknown", None), (91, None, "en")], "id long, text string, lang string")
    profile = languages.learn(df, kept=25)
    counts = {lang: Counter(g for t in ts for g in grams(t)) for lang, ts in SAID.items()}
    kept = {g for c in counts.values() for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:25]}
    want = {(lang, g): round(1000 * math.log((c[g] + 1) / (sum(c.values()) + len(kept)))) for lang, c in counts.items() for g in kept}
    assert {(r.lang, r.gram): r.weight for r in profile.collect()} == want
    texts = ["the" * 40 + "staff" * 50, "The waiter was KIND", "das war nicht gut", "la cuenta", "", None, "123 !!", "日本", "the the das"]
    asked = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.detected for r in languages.identify(asked, profile, "id").collect()}
    for k, text in enumerate(texts):
        known = [g for g in grams(text) if g in kept]
        scores = {lang: sum(want[lang, g] for g in known) for lang in SAID}
        assert got[k] == (min(SAID, key=lambda x: (-scores[x], x)) if known else None)
    assert [got[k] for k in range(1, 4)] == ["en", "de", "es"]


def test_rows_are_kept_and_long_texts_take_linear_work(spark):
    profile = languages.learn(spark.createDataFrame(ROWS, "id long, text string, lang string"))
    rows = [(None, "the food and the staff"), (1, "x" * 3_000_000), (2, "das Essen " * 30_000), (2, "das Essen")]
    out = languages.identify(spark.createDataFrame(rows, "id long, text string").withColumn("lang", F.lit("?")), profile, "id")
    assert sorted((r.id or 0, r.detected) for r in out.collect() if r.id != 1) == [(0, "en"), (2, "de"), (2, "de")]
    assert out.columns == ["id", "text", "lang", "detected"] and out.count() == 4
    assert languages.identify(out.select("id", "text").where("false"), profile, "id").isEmpty()


def test_gate_without_a_language_column(spark):
    profile = languages.learn(spark.createDataFrame(ROWS, "id long, text string, lang string"))
    df = spark.createDataFrame([(1, "the staff"), (2, "the food was good"), (3, "die Rechnung"), (4, "...")], "id long, text string")
    row = languages.text_language_gate(df, profile, "id", ["en"], 0.5).first()
    assert (row.n_rows, row.observed_share, row.success) == (4, 0.5, True)
    assert not languages.text_language_gate(df, profile, "id", ["en"], 0.6).first().success
