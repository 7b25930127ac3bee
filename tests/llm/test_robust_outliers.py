import math
import re
from collections import Counter

import numpy as np
import pytest

from opinara.llm import robust_outliers as m
from tests.llm.helpers import AWKWARD, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if twice[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_counts_against_plain_python(spark):
    texts = [*AWKWARD, "a b c a b c a", "x\nx\n \nx", "é|#\x0b\x0c b", "a a a a a", prose(300, 1, 4), "\x85x \xa0y", prose(10_000, 2, 20)]
    got = m.text_counts(documents(spark, texts).drop("kept", "score")).orderBy("doc_id").select(*m.COUNTS).collect()
    assert [tuple(r) for r in got] == [counts(t) for t in texts]


@pytest.mark.parametrize("dof", [4, 6])
def test_chi_square_bounds(dof):
    assert m.chi2_within(m.chi2_bound(0.975, dof), dof) == pytest.approx(0.975)
    assert m.chi2_bound(0.975, 4) == pytest.approx(11.1433, abs=1e-3)


def vector(c, n_lines):
    n, chars, symbols, dup, rep = c
    shares = (chars / max(n, 1), 0.01 + symbols / max(chars, 1), 0.05 + dup / max(n_lines, 1), 0.05 + rep / max(n, 1))
    return [round(m._SCALE * math.log(max(s, 1e-3))) for s in shares]


def quantile(values, share):
    ordered = sorted(values)
    return ordered[max(0, math.ceil(share * len(ordered)) - 1)]


def brute_distances(x):
    """The same estimate with numpy over one group; squared distances in hundredths."""
    x = np.array(x, float)
    floors = np.array(m.FLOORS) * m._SCALE
    centre = np.array([quantile(c, 0.5) for c in x.T])
    spread = [math.sqrt((1.4826 * quantile(np.abs(c - k), 0.5)) ** 2 + f**2) for c, k, f in zip(x.T, centre, floors, strict=True)]
    scatter = np.diag(np.square(spread))

    def distance():
        d = x - centre
        return np.minimum(np.floor(100 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(scatter), d) + 1e-9), m._FAR)

    for step in range(m.STEPS + 1):
        d2 = distance()
        share = m.CORE if step < m.STEPS else 0.975
        near = x[d2 <= (quantile(d2, m.CORE) if step < m.STEPS else int(100 * m.chi2_bound(share, 4)))]
        centre = near.mean(axis=0)
        scatter = m._consistency(share) * np.cov(near.T, bias=True) + np.diag(floors**2)
    return distance()


def test_verdicts_against_numpy_per_group(spark):
    texts = []
    for k in range(420):
        text = prose(60 + k % 90, k, 200)
        if k % 7 == 0:
            text = text.replace(" ", " # ", k % 40)
        if k % 11 == 0:
            text = "\n".join([text[:80]] * 3) + "\n" + text
        texts.append(text)
    texts += [prose(120, 900, 200).replace(" ", "### "), "junk | | | | " * 30 + prose(100, 901, 200)]
    rows = [(i, t, "en", "big" if i % 4 else "other") for i, t in enumerate(texts)] + [(1000 + i, t, None, None) for i, t in enumerate(AWKWARD)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, key int")
    got = {r.doc_id: r for r in m.robust_outliers(docs, least=50).collect()}
    for source in ("big", "other"):
        own = [(i, t) for i, t, _, s in rows if s == source and not got[i].base_failed]
        d2 = brute_distances([vector(counts(t), len([x for x in t.split("\n") if x.strip()])) for _, t in own])
        bound = int(100 * m.chi2_bound(m.WITHIN, 4))
        for (i, _), d in zip(own, d2, strict=True):
            assert got[i].distance == pytest.approx(d / 100, abs=0.0101)
            assert got[i].kept == (d <= bound) or abs(d - bound) <= 1
    assert not got[len(texts) - 1].kept and not got[len(texts) - 2].kept
    for i, t in enumerate(AWKWARD):
        c = counts(t)
        assert got[1000 + i].base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert got[1000 + i].distance is None


def test_empty_table(spark):
    assert m.robust_outliers(documents(spark, [])).count() == 0
