import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import byte_bpe
from opinara.llm.pieces import ChunkCoder, chunks, pieces, text_of
from tests.llm.helpers import AWKWARD, documents, prose

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coders():
    with open(PATH, "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    encoder = byte_bpe.BytePairEncoder(ranks, PATTERN)
    return encoder, ChunkCoder(encoder.encode_chunks), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t.'s1  \x1c\x85　日<|>\r"), max_size=60))
def test_any_text_as_the_library_encodes_it(coders, text):
    _, coder, library = coders
    assert ids(coder([text])[0]) == library.encode_ordinary(text)


def test_pieces_of_every_length(coders):
    encoder, _, library = coders
    r = random.Random(5)
    for n in [1, 2, 3, 4, 5, 63, 64, 65, byte_bpe.LONGEST - 1, byte_bpe.LONGEST, byte_bpe.LONGEST + 1, 900]:
        for alphabet in ("a", "ab", "ethanous", "éß"):
            word = "".join(r.choice(alphabet) for _ in range(n))
            assert ids(encoder.encode_pieces([word.encode()])[0]) == library.encode_ordinary(word)


def test_pair_table_knows_every_pair_and_no_other(coders):
    encoder, _, _ = coders
    some = [t for t in list(encoder.ranks)[::97] if len(t) > 1]
    for token in some:
        for cut in range(1, len(token)):
            a, b = encoder.ranks.get(token[:cut]), encoder.ranks.get(token[cut:])
            if a is not None and b is not None:
                assert encoder.pairs(np.array([a]), np.array([b]))[0] == encoder.ranks[token]
    none = encoder.pairs(np.arange(1000), np.arange(1000)[::-1])
    joined = [encoder.ranks.get(encoder.tokens[a] + encoder.tokens[999 - a]) for a in range(1000)]
    assert [None if x >= 1 << 40 else x for x in none.tolist()] == joined


def test_chunks_join_to_the_text():
    for text in [t for t in AWKWARD if t is not None] + ["\nx", "x\n", "a\n\nb", " a", "a ", "a\tb c"]:
        assert "".join(text_of(p) for c in chunks(text) for p in pieces(c)) == text


def test_memory_may_be_cleared(coders):
    encoder, _, library = coders
    coder = ChunkCoder(encoder.encode_chunks, memory=10)
    for k in range(3):
        assert ids(coder([prose(50, k)])[0]) == library.encode_ordinary(prose(50, k))


def test_documents_round_trip(spark, coders):
    import hashlib

    texts = [*AWKWARD, "dup", "dup"]
    got = byte_bpe.encode_documents(documents(spark, texts), PATH, PATTERN).orderBy("doc_id").collect()
    for row, text in zip(got, texts, strict=True):
        own = coders[2].encode_ordinary(text or "")
        assert (row.n_tokens, ids(row.ids)) == (len(own), own)
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert row.ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
    assert byte_bpe.encode_documents(documents(spark, []), PATH, PATTERN).count() == 0
