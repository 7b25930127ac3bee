import random
import zlib

from opinara.llm import pu_toxicity as p
from tests.llm.helpers import AWKWARD, documents, prose

BAD = ["grubnik", "snorlop", "vexitude", "blaggard"]


def corpus(n=400):
    r = random.Random(1)
    texts, toxic = [], []
    for k in range(n):
        own = prose(r.randint(30, 150), k, 300).split()
        bad = r.random() < 0.2
        if bad:
            for _ in range(3):
                own.insert(r.randrange(len(own)), r.choice(BAD))
        texts.append(" ".join(own))
        toxic.append(int(bad))
    return texts, toxic


def label_frame(spark, toxic, every=2):
    rows = [(i, 1, y, "clash") for i, y in enumerate(toxic) if i % every == 0]
    rows += [(None, 1, 1, "clash"), (0, 1, None, "clash"), (10**6, 1, 1, "clash")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy_and_contract(spark):
    texts, toxic = corpus()
    docs = documents(spark, texts + AWKWARD)
    got = p.toxicity(docs, label_frame(spark, toxic)).orderBy("doc_id").collect()
    assert [r.held_out for r in got] == [zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    right = [got[i].predicted == y for i, y in enumerate(toxic)]
    assert sum(right) / len(right) > 0.97
    assert not any(r.predicted for r in got[len(texts) :])


def test_held_out_labels_change_nothing(spark):
    texts, toxic = corpus(200)
    docs = documents(spark, texts)
    flipped = [1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y for i, y in enumerate(toxic)]
    a, b = (p.train(docs, label_frame(spark, y, 1)) for y in (toxic, flipped))
    assert a.features.tolist() == b.features.tolist() and a.weights.tolist() == b.weights.tolist()


def test_without_positives_everything_is_clean(spark):
    texts, toxic = corpus(30)
    docs = documents(spark, texts)
    for labels in (label_frame(spark, [0] * 30).where("doc_id < 100"), label_frame(spark, toxic).where("false")):
        assert {r.predicted for r in p.toxicity(docs, labels).collect()} == {0}
    assert p.toxicity(docs.where("false"), label_frame(spark, toxic)).count() == 0


def test_filter_keeps_columns_and_clean_rows(spark):
    texts, toxic = corpus(300)
    docs = documents(spark, texts)
    kept = p.drop_toxic(docs, p.train(docs, label_frame(spark, toxic, 1)))
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    clean = {i for i, y in enumerate(toxic) if not y}
    assert len(left ^ clean) <= 0.03 * len(texts)


def test_risk_does_not_reward_false_alarms():
    """A feature as common in unlabelled text as in positives loses its weight."""
    positive = [[0, 1]] * 50
    unlabelled = [[0, 1]] * 20 + [[1]] * 180
    weights, intercept = p.fit_nnpu(positive, unlabelled, 2, 0.1)
    assert p.sigmoid(weights[0] + weights[1] + intercept) > 0.5 > p.sigmoid(weights[1] + intercept)
