import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import order_minhash as o
from tests.llm.helpers import AWKWARD, documents, prose


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def similar(a, b):
    a, b = o.shingles(a.encode().split()), o.shingles(b.encode().split())
    m = lcs(a, b)
    return bool(a and b) and m >= 0.8 * (len(a) + len(b) - m)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_alignment_within_the_band(a, b):
    assert o.matched(a, b, 60) == lcs(a, b)
    m = lcs(a, b)
    assert o.linked(a, b) == bool(a and b and m >= 0.8 * (len(a) + len(b) - m) - 1e-9)


def edited(text, n, r):
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_classes_against_brute_force(spark):
    r = random.Random(3)
    texts = [*AWKWARD, "one", "", "two words", "two  words"]
    for k in range(12):
        base = prose(r.choice([30, 80, 300]), k)
        texts += [base, base, *(edited(base, n, r) for n in (1, 1, 2, 4, 9))]
    shared = prose(60, 77)
    texts += [f"{prose(60, 500 + k)} {shared} {prose(60, 600 + k)}" for k in range(30)]
    reordered = prose(100, 55).split()
    texts += [" ".join(reordered), " ".join(reordered[50:] + reordered[:50])]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "").split() and (texts[i] == texts[j] or similar(texts[i] or "", texts[j] or "")):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {x.doc_id: x for x in o.near_duplicates(documents(spark, texts).repartition(7)).collect()}
    assert [got[i].class_id for i in range(len(texts))] == [root(i) for i in range(len(texts))]
    assert sorted(i for i, x in got.items() if x.kept) == sorted({root(i) for i in range(len(texts))})
    sizes = [sum(root(j) == root(i) for j in range(len(texts))) for i in range(len(texts))]
    assert [got[i].class_size for i in range(len(texts))] == sizes


def test_short_copies_against_brute_force(spark):
    """A word more at an end of 8 to 40 words, two in 12; copies of one short text; one line in many."""
    texts = []
    for k in range(60):
        n = 8 + k % 33
        base = prose(n, 900 + k)
        texts += [base, f"{base} more" if k % 2 else f"more {base}"]
    for k in range(40):
        base = prose(12, 2000 + k)
        texts += [base, f"front {base} back"]
    hot = prose(24, 3000)
    texts += [f"{hot} end{k}" for k in range(100)]
    texts += [f"{prose(12, 77)} {prose(8 + k % 9, 4000 + k)}" for k in range(100)]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or similar(texts[i], texts[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = [root(i) for i in range(len(texts))]
    assert len(set(want)) < 240
    got = {x.doc_id: x.class_id for x in o.near_duplicates(documents(spark, texts).repartition(5)).collect()}
    assert [got[i] for i in range(len(texts))] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefghij"), min_size=1, max_size=45), st.data())
def test_links_of_short_texts_share_a_key(words, data):
    other = list(words)
    for _ in range(data.draw(st.integers(1, 3))):
        at = data.draw(st.integers(0, len(other)))
        other[at : at + data.draw(st.integers(0, 1))] = data.draw(st.lists(st.sampled_from("abx"), max_size=2))
    a, b = ([w.encode() for w in x] for x in (words, other))
    if min(len(o.shingles(a)), len(o.shingles(b))) <= o.SHORT and o.linked(o.shingles(a), o.shingles(b)):
        sketcher = o.Sketcher()
        assert set(sketcher.keys(a).tolist()) & set(sketcher.keys(b).tolist())


@pytest.mark.parametrize("stars", [0, 1])
def test_the_last_round_finds_what_stars_leave(spark, stars):
    """A chain of edits: no representative is near all, but each is near the next."""
    words = prose(100, 5).split()
    texts = []
    for k in range(12):
        words = [*words]
        words[k * 8] = f"step{k}"
        texts.append(" ".join(words))
    got = o.near_duplicates(documents(spark, texts), stars=stars).collect()
    assert {r.class_id for r in got} == {0}


def test_sketches_follow_order_and_occurrence():
    sketch = o.Sketcher()
    a = prose(200, 1).encode().split()
    assert (sketch(a) == sketch(list(a))).all()
    assert (sketch(a) == sketch(a[100:] + a[:100])).mean() < 0.5
    assert len(sketch([])) == 0 and len(sketch([b"w"])) == o.SKETCHES
    assert (sketch([b"w"] * 40) != sketch([b"w"] * 20)).any()


def test_filter_keeps_one_row_of_each_class(spark):
    docs = documents(spark, [prose(50, 1), prose(50, 1), prose(50, 2), "", None, prose(50, 2) + " more"])
    kept = o.drop_near_duplicates(docs.unionByName(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]
    assert o.near_duplicates(docs.where("false")).count() == 0
    null_ids = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "c d")], "doc_id long, text string")
    assert o.drop_near_duplicates(null_ids).count() == 2
