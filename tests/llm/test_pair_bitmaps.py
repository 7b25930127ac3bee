import hashlib
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opinara.llm import pair_bitmaps as p
from tests.llm.helpers import AWKWARD, documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spans(tokens):
    at, out = 0, []
    for token, size in tokens:
        out.append((at, at + size, token))
        at += size
    return out


def brute(docs):
    """The contract over whole texts with both libraries."""
    a_library = Tokenizer.from_file(A)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=B)
    own = {chr(letter): byte for byte, letter in p.byte_letters().items()}

    def a_bytes(i):
        return bytes(own[c] for c in a_library.id_to_token(i))

    def b_bytes(i):
        piece = b_library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode()

    found, count, docs_of = [], Counter(), defaultdict(set)
    for doc, text in docs:
        a = a_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        left, right = spans([(i, len(a_bytes(i))) for i in a]), spans([(i, len(b_bytes(i))) for i in b])
        links, at = [], 0
        for lo, hi, i in left:
            while at < len(right) and right[at][1] <= lo:
                at += 1
            k = at
            while k < len(right) and right[k][0] < hi:
                links.append((i, right[k][2]))
                k += 1
        ends = {e for _, e, _ in left} & {e for _, e, _ in right}
        sides = []
        for side in (left, right):
            parts, now = [], []
            for _, e, i in side:
                now.append(str(i))
                if e in ends:
                    parts.append(",".join(now))
                    now = []
            sides.append(parts)
        count.update(links)
        for link in set(links):
            docs_of[link].add(doc)
        found.append((doc, len(a), len(b), len(ends), links, ";".join(map("|".join, zip(*sides)))))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    rows = {
        doc: (na, nb, ng, len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), hashlib.sha256(g.encode()).hexdigest() if na else "")
        for doc, na, nb, ng, ls, g in found
    }
    return rows, {x: (len(docs_of[x]), n, n == best[x[1]]) for x, n in count.items()}


def corpus(n=900):
    r = random.Random(3)
    words = ["the", " of", "▁", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "①", "x1", "'s", "###", "\r\n", "\xa0", "　", "\x85", "\x1c", "word", "ing", ",", "😀", "<|endoftext|>"]
    plain = ["the", "of", "thion", "schung", "chané,", "heeshe.", "the\nBe", "it's"]
    for k in range(n):
        yield "".join(r.choice(words) for _ in range(r.randint(1, 40))) if k % 2 else " ".join(r.choice(plain) for _ in range(r.randint(1, 300)))


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block", [4096, 300])
def test_documents_and_pairs_as_the_libraries_give_them(spark, block):
    texts = [*AWKWARD, "dup dup", "dup dup", "<|endoftext|> a<s>", "▁x", "  a   b \n\n c\n  d\n\ne \n f", *corpus()]
    docs = documents(spark, texts).withColumnRenamed("node", "block").withColumnRenamed("id", "place").repartition(3)
    rows, pairs = brute(enumerate(texts))
    found = p.align_documents(docs, A, B, block_docs=block).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found} == rows and len(found) == len(rows)
    assert sum(r[0] == 0 for r in rows.values()) > 10
    _, planes = p.align(docs, A, B, block_docs=block)
    assert planes.select("block").distinct().count() >= (3)
    assert {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in p.pair_counts(planes).collect()} == pairs


def test_remembered_chunks_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(p, "MEMORY", 1 << 20)
    with open(A, "rb") as a, open(B, "rb") as b:
        files = a.read(), b.read()
    work, r = p.Aligner(*files), random.Random(5)

    def size(x):
        return sum(map(sys.getsizeof, x)) if isinstance(x, tuple) else sys.getsizeof(x)

    texts = ["".join(r.choices("abcdefgh", k=20_000)) + " so it is" for _ in range(60)]
    texts += texts[-3:]
    got = [work([t]) for t in texts]
    assert sum(size(k) + size(e) for d in vars(work).values() if isinstance(d, dict) for k, e in d.items()) < 3 << 20
    for k in (0, 59, 62):
        for mine, fresh in zip(got[k], p.Aligner(*files)([texts[k]]), strict=True):
            assert np.array_equal(mine, fresh) if isinstance(mine, np.ndarray) else list(map(list, mine)) == list(map(list, fresh))


def test_long_batches_are_taken_in_parts(monkeypatch):
    monkeypatch.setattr(p, "PART_BYTES", 100)
    sizes = [0, 250, 3, 3, 99, 0, 100, 7]
    batch = p.pa.RecordBatch.from_arrays([p.pa.array(range(9)), p.pa.array([b"x" * n for n in [5, *sizes]])], ["doc", "bytes"])
    for b in (batch, batch.slice(1)):
        found = list(p.parts(b))
        assert len(found) > 2 and p.pa.Table.from_batches(found).equals(p.pa.Table.from_batches([b]))
        assert all(sum(map(len, x.column(1).to_pylist()[1:])) < 200 for x in found)


def test_empty_table(spark):
    docs = documents(spark, ["x"]).where("false")
    assert p.align_documents(docs, A, B).count() == 0
    only_null = documents(spark, [None, ""])
    assert [tuple(r)[1:] for r in p.align_documents(only_null, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@pytest.mark.parametrize("n", [1, 40, 4096])
def test_bitmaps_hold_what_went_in(n):
    r = np.random.default_rng(n)
    sets = [np.flatnonzero(r.random(n) < share) for share in (0.001, 0.01, 0.3, 1, 0.02)]
    sets = [s if len(s) else np.array([n - 1]) for s in sets]
    sizes = np.array(list(map(len, sets)))
    bitmaps, order = p.pack(np.concatenate(sets), sizes, n)
    dense = (sizes * 2 > -(-n // 8))[order]
    rows, docs = p.unpack(bitmaps, dense)
    for k, at in enumerate(order):
        assert sorted(docs[rows == k].tolist()) == sets[at].tolist()
        assert len(bitmaps[k].as_py()) == min(2 * len(sets[at]), -(-n // 8))
