import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinara.llm import wavelet_tokens as w
from tests.llm.helpers import AWKWARD, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (7, 2), (700, 3), (5_000, 50_257), (1_300, 70_000)])
def test_matrix_answers_like_the_array(n, top):
    ids = np.random.default_rng(n).integers(0, top, n)
    m = w.WaveletMatrix.load(w.WaveletMatrix.build(ids, np.array([0])).dump())
    assert m.ids().tolist() == ids.tolist()
    if n:
        at = np.random.default_rng(1).integers(0, n, 40)
        assert m.access(at).tolist() == ids[at].tolist()
        for value in {int(ids[0]), int(ids[-1]), 0, top + 5}:
            where = np.flatnonzero(ids == value).tolist()
            assert m.count(value) == len(where)
            assert m.rank(value, n // 3, n // 2) == sum(n // 3 <= x < n // 2 for x in where)
            assert m.occurrences(value)[:20] == where[:20] if len(where) < 60 else m.select(value, 50) == where[50]
    with pytest.raises(IndexError):
        m.select(0, n + 1)


def test_files_read_back_as_the_library_encodes(spark, tmp_path):
    texts = [*AWKWARD, "dup", "dup", "<|endoftext|> here", *(prose(300, k) for k in range(40))]
    docs = documents(spark, texts).repartition(5)
    tokenizer = Tokenizer.from_file(PATH)
    folder = str(tmp_path / "shards")
    got = w.token_file_digest(docs, PATH, folder, shard_ids=2_000).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(got, texts, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    shards = spark.read.parquet(folder)
    assert shards.count() > 5
    one = shards.orderBy("part", "seq").first()
    m = w.WaveletMatrix.load(one.matrix)
    assert m.count(w.END) >= len(one.doc_ids) and m.slice(0)[0] == 0


def test_null_ids_come_first_and_repeats_stay(spark):
    docs = spark.createDataFrame([(None, "a"), (3, "b"), (3, "b"), (-1, None)], "doc_id long, text string")
    got = w.token_file_digest(docs, PATH).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -1, 3, 3] and [r.start for r in got] == [0, 2, 3, 5]
    assert w.token_file_digest(docs.where("false"), PATH).count() == 0


def spelt(n):
    r = random.Random(n)
    end = "<|endoftext|>"
    for _ in range(n):
        yield r.choice([
            lambda: "".join(r.choice([end, end, " ", "  ", "\n", "a", "the", "<|end", "oftext|>", "é", ".", "###", "'s"]) for _ in range(r.randint(1, 15))),
            lambda: " ".join(r.choice(["word", "chané###", "it's", "a,%%%", "x1", "don't.", "(the)", "---", "日本。", end]) for _ in range(r.randint(1, 20))),
            lambda: "".join(r.choice(" \n\t\r\x85\u3000ab'sd1#.é①") for _ in range(r.randint(1, 40))),
        ])()


@pytest.mark.parametrize("as_text", [False, True])
def test_ids_are_the_librarys_for_texts_that_spell_added_tokens(as_text):
    tokenizer = Tokenizer.from_file(PATH)
    if as_text:
        tokenizer.encode_special_tokens = True
    with open(PATH, "rb") as f:
        coder = w.LibraryCoder(f.read(), as_text)
    texts = ["<|endoftext|>", "<|endoftext|>" * 3, "in<|endoftext|>word", " <|endoftext|> ", *spelt(4_000)]
    for text, packed in zip(texts, coder(texts), strict=True):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert any((50256 in np.frombuffer(p, "<u4")) for p in coder(texts[:1])) is not as_text
