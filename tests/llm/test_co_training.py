import random

from opinara.llm import co_training as c
from tests.llm.helpers import AWKWARD, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, y int"


def corpus(spark, n=500):
    r = random.Random(6)
    rows, good = [], []
    for k in range(n):
        ok = r.random() < 0.75
        text = prose(r.randint(40, 120), k)
        if not ok:
            text = text.replace(" ", " | ") if k % 2 else text.upper().replace(" ", "### ")
        source = f"src{r.randrange(4) if ok else 4 + r.randrange(4)}" if r.random() < 0.8 else None
        rows.append((k, text, "en", source, len(text), 1.0, 5))
        good.append(int(ok))
    rows += [(n + k, t, None, None, None, 1.0, 5) for k, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, SCHEMA), good


def labels(spark, good, every=3):
    rows = [(i, y, 0) for i, y in enumerate(good) if i % every == 0] + [(None, 1, 0), (1, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_of_each_view(spark):
    docs, good = corpus(spark)
    got = c.quality(docs, labels(spark, good)).orderBy("doc_id").collect()
    own = got[: len(good)]

    def accuracy(column):
        return sum((r[column] >= 0.5) == bool(y) for r, y in zip(own, good, strict=True)) / len(good)

    assert accuracy("score") > 0.97 and accuracy("text_score") > 0.95 and accuracy("meta_score") > 0.8
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) == bool(r.predicted) for r in got)


def test_one_class_or_no_labels_give_the_share(spark):
    docs, good = corpus(spark, 20)
    assert {r.score for r in c.quality(docs, labels(spark, [1] * 20)).collect()} == {1.0}
    assert {r.score for r in c.quality(docs, labels(spark, good).where("false")).collect()} == {0.5}
    assert c.quality(docs.where("false"), labels(spark, good)).count() == 0


def test_features_have_one_length_and_no_nans():
    sizes = {len(c.text_features((t or "").encode())) for t in AWKWARD}
    assert len(sizes) == 1
    assert all(x == x for t in AWKWARD for x in c.text_features((t or "").encode()))
    assert c.meta_features(None, None, None) != c.meta_features("en", "s", 3)
