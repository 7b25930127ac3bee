import hashlib
import random
from collections import Counter

import pytest

from opinara.llm import suffix_merge as s
from tests.llm.helpers import AWKWARD, documents, prose


def brute(texts):
    """Removed runs of every text, by counting all strings."""
    counts = Counter(t[k : k + s.LENGTH] for t in texts for k in range(len(t) - s.LENGTH + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - s.LENGTH + 1):
            if counts[t[k : k + s.LENGTH]] > 1:
                gone[k : k + s.LENGTH] = b"\1" * s.LENGTH
        runs = [k for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((len(t), sum(gone), len(runs), hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def corpus():
    r = random.Random(8)
    passage = prose(80, 1)
    texts = [*AWKWARD[:-2], "x" * 700, "ab" * 400, prose(300, 3), prose(300, 3)]
    texts += [f"{prose(30, 100 + k)} {passage[r.randint(0, 40):]} {prose(30, 200 + k)}" for k in range(25)]
    base = prose(250, 7).split()
    for _ in range(25):
        own = base.copy()
        own[r.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    twice = prose(60, 9)
    return [*texts, f"{twice} {prose(20, 10)} {twice}", "é" * 150, "é" * 101]


@pytest.mark.parametrize("gathered", [s.GATHERED, 3])
def test_against_brute_force(spark, monkeypatch, gathered):
    """Also with hashes beyond what one task gathers."""
    monkeypatch.setattr(s, "GATHERED", gathered)
    texts = corpus()
    got = s.remove_repeats(documents(spark, texts).repartition(6)).orderBy("doc_id").collect()
    data = [(t or "").encode() for t in texts]
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute(data)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    for r, t in zip(got, data, strict=True):
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2], strict=True)) == r.n_removed <= len(t)


def test_merged_transforms_against_counting():
    r = random.Random(2)
    for case in range(25):
        base = [bytes(r.choice(b"ab") for _ in range(r.randint(200, 300))) for _ in range(2)]
        texts = {b"a" * 240} if case % 5 == 0 else set()
        for _ in range(r.randint(1, 8)):
            texts.add(bytes(r.choice(b"ab") for _ in range(r.randint(0, 40))) + r.choice(base)[r.randint(0, 20) :] + bytes(r.choice(b"ab") for _ in range(r.randint(20, 60))))
        texts = sorted(t for t in texts if len(t) >= s.LENGTH)
        weights = [r.choice([1, 1, 2]) for _ in texts]
        counts = Counter()
        for t, w in zip(texts, weights, strict=True):
            for k in range(len(t) - s.LENGTH + 1):
                counts[t[k : k + s.LENGTH]] += w
        want = [[k for k in range(len(t) - s.LENGTH + 1) if counts[t[k : k + s.LENGTH]] > 1] for t in texts]
        for shards in (1, 3):
            assert [x.tolist() for x in s.repeated_starts(texts, weights, shards)] == want


def test_only_runs_that_may_repeat_are_merged(monkeypatch):
    """The transforms hold no text around a string whose pieces occur once."""
    rows = []
    merge = s.merge
    monkeypatch.setattr(s, "merge", lambda shards: rows.append(sum(len(x.full) for x in shards)) or merge(shards))
    shared = [prose(80, k).encode()[:260] for k in (1, 2)]
    texts = [prose(60, 10 + k).encode() + shared[0] + prose(60, 30 + k).encode() + shared[1][k:] for k in range(8)]
    texts.append(prose(90, 50).encode())
    got = s.repeated_starts(texts, [1] * len(texts))
    counts = Counter(t[k : k + s.LENGTH] for t in texts for k in range(len(t) - s.LENGTH + 1))
    assert [x.tolist() for x in got] == [[k for k in range(len(t) - s.LENGTH + 1) if counts[t[k : k + s.LENGTH]] > 1] for t in texts]
    assert min(len(x) for x in got[:8]) > 100 and not len(got[8])
    runs = sum(len(s._runs(x)) // 2 for x in got)
    repeated = sum(len(x) for x in got)
    # A run of starts is merged with the bytes of its last string and, by chance, a few starts around it.
    assert len(rows) == 1 and repeated + runs * s.LENGTH <= rows[0] <= repeated + runs * (s.LENGTH + 60) < sum(map(len, texts)) * 2 // 3
    assert not any(len(x) for x in s.repeated_starts(texts[8:], [1])) and len(rows) == 1
    assert not any(len(x) for x in s.repeated_starts([b"", b"short"], [1, 2])) and len(rows) == 1
    [both] = s.repeated_starts(texts[8:], [2])
    assert both.tolist() == list(range(len(texts[8]) - s.LENGTH + 1))


def test_a_shard_is_its_text_sorted():
    texts = [prose(60, k).encode()[:260] for k in range(3)]
    shard = s.Shard(texts)
    source, row, block = s.merge([shard])
    assert sorted(row.tolist()) == list(range(len(shard.rows))) and not source.any()
    strings = {}
    for place, b in zip(shard.rows[row].tolist(), block.tolist(), strict=True):
        own, at = int(shard.owner[place]), int(shard.local[place])
        if len(texts[own]) - at >= s.LENGTH:
            assert strings.setdefault(b, texts[own][at : at + s.LENGTH]) == texts[own][at : at + s.LENGTH]
    assert len(strings) == len(set(strings.values()))


def test_equal_strings_share_a_stretch_hash():
    a, b = prose(80, 5).encode(), prose(120, 6).encode()
    texts = [a + b, b + a, b"z" * 400, b""]
    own, hashes, first, last = s.stretches(texts)
    by_string = {}
    for k, h, x, y in zip(own.tolist(), hashes.tolist(), first.tolist(), last.tolist(), strict=True):
        for start in range(x, y + 1):
            assert by_string.setdefault(texts[k][start : start + s.LENGTH], h) == h
    assert sum((last - first + 1).tolist()) == sum(max(0, len(t) - s.LENGTH + 1) for t in texts)


def across_multiples(count):
    """A text with a run of 250 bytes, of its own repeated unit, across each multiple of 2 ** 17."""
    r = random.Random(4)
    out = b""
    for k in range(1, count + 1):
        unit = bytes(r.choices(range(33, 91), k=1 + 12 * k % 97))
        out += bytes(r.choices(range(97, 123), k=(k << 17) - 60 - 10 * (k % 14) - len(out)))
        out += (unit * 250)[:250]
    return out + bytes(r.choices(range(97, 123), k=300))


def test_equal_strings_never_share_a_stretch():
    text = across_multiples(12)
    own, _, first, last = s.stretches([text, text[:-7]])
    assert sum((last - first + 1).tolist()) == 2 * (len(text) - s.LENGTH + 1) - 7
    for k, a, b in zip(own.tolist(), first.tolist(), last.tolist(), strict=True):
        assert k in (0, 1) and len({text[x : x + s.LENGTH] for x in range(a, b + 1)}) == b - a + 1


def test_runs_across_blocks_are_removed(spark):
    text = across_multiples(6)
    got = s.remove_repeats(spark.createDataFrame([(0, text.decode())], "doc_id long, text string")).first()
    [want] = brute([text])
    assert want[2] >= 4 and (got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256) == want


def test_empty_table_and_single_rows(spark):
    assert s.remove_repeats(documents(spark, [])).count() == 0
    got = s.remove_repeats(documents(spark, [prose(100, 1)])).first()
    assert got.n_removed == 0 and got.spans == []
