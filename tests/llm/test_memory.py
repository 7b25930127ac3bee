import random
import sys
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from opinara.llm import byte_bpe, common, order_minhash, pu_toxicity
from opinara.llm.pieces import ChunkCoder
from tests.llm.helpers import prose

PATTERN = public_tokenizers.PATTERN
with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
    VOCABULARY = f.read()


def held(work):
    """Bytes of all that an object remembers, itself or in its memory."""
    own = vars(work) | vars(getattr(work, "memory", None) or common)
    return sum(sys.getsizeof(k) + sys.getsizeof(v) for d in own.values() if isinstance(d, dict) for k, v in d.items())


def long_words(n, size):
    r = random.Random(5)
    return ["".join(r.choices("abcdefgh", k=size)) + " so it is." for _ in range(n)]


def test_remembered_chunks_are_bounded_in_bytes():
    ranks = byte_bpe.parse_ranks(VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = ChunkCoder(byte_bpe.BytePairEncoder(ranks, PATTERN).encode_chunks, memory=100_000)
    texts = long_words(60, 5_000) + [prose(50, k) for k in range(20)]
    texts += texts[50:60]
    for t in texts:
        assert np.frombuffer(coder([t])[0], "<u4").tolist() == library.encode_ordinary(t)
    assert held(coder) < 300_000


@pytest.mark.parametrize("kind", [order_minhash.Sketcher, lambda: pu_toxicity.Features(np.arange(1 << 12))])
def test_remembered_words_are_bounded_in_bytes(monkeypatch, kind):
    for cls in (order_minhash.Sketcher, pu_toxicity.Features):
        monkeypatch.setattr(cls, "MEMORY", 100_000)
    work, texts = kind(), [t.encode() for t in long_words(60, 5_000)]
    read = lambda of, t: of.items(t.split()).tolist() if hasattr(of, "items") else of(t)
    for t in [*texts, *texts[-3:]]:
        assert read(work, t) == read(kind(), t)
    assert held(work) < 300_000 + 80 * (1 << 12)  # the features' own numbers


def test_a_worker_keeps_one_operators_memory_at_a_time():
    features = pu_toxicity._features(np.array([5, 9]))
    assert pu_toxicity._features(np.array([5, 9])) is features
    gone = weakref.ref(features)
    del features
    coder = byte_bpe._coder(VOCABULARY, PATTERN)
    assert gone() is None and byte_bpe._coder(VOCABULARY, PATTERN) is coder
    gone = weakref.ref(coder[1])
    del coder
    common.forget()
    assert gone() is None


def test_memory_takes_over_what_is_in_use():
    memory, learnt = common.Memory(1_000), []

    def learn(new):
        learnt.extend(new)
        return {k: b"" for k in new}

    for k in range(200):
        assert {"often", f"{k}"} <= set(memory.recall({"often", f"{k}"}, learn))
    assert learnt.count("often") == 1 and len(learnt) == 201
    assert len(memory.known) + len(memory.older) < 30


@pytest.mark.parametrize("sizes", [[], [0], [5, 0, 250, 3, 3, 99, 0, 100, 7]])
def test_long_batches_are_taken_in_parts(monkeypatch, sizes):
    monkeypatch.setattr(common, "PART_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), pa.array([b"x" * n for n in sizes], pa.binary())], ["doc", "bytes"])
    found = list(common.parts(batch, 1))
    assert pa.Table.from_batches(found, batch.schema).equals(pa.Table.from_batches([batch]))
    assert all(sum(map(len, x.column(1).to_pylist()[1:])) < 200 for x in found) and len(found) >= len(sizes) // 4
