import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from opinara.llm import piece_backtrack as b
from tests.llm.helpers import AWKWARD, documents, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def memory():
    with open(PATH, "rb") as f:
        return b.PieceMemory(f.read())


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = list(b.PieceEncoder(open(PATH, "rb").read()).texts.values())
    for _ in range(n):
        yield r.choice([
            lambda: "".join(r.choice(" ▁ab\n\tthe é日本ﬁ①\r\x00😀<s>") for _ in range(r.randint(0, 60))),
            lambda: "".join(r.choice(vocabulary).replace("▁", r.choice([" ", "▁"])) for _ in range(r.randint(0, 12))),
            lambda: " " * r.randint(0, 70) + r.choice(vocabulary) + " " * r.randint(0, 40) + r.choice("ab\n "),
            lambda: "".join(r.choice("aeinrst") for _ in range(r.randint(1, 200))),
            lambda: r.choice("=-*/#\r)};") * r.randint(1, 90) + "".join(r.choice("=-*/#\r)};(") for _ in range(30)),
            lambda: "".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x400, 0x500), r.randrange(0x4E00, 0x9FFF), r.randrange(0x1F300, 0x1F600)])) for _ in range(r.randint(1, 40))),
        ])()


def test_ids_and_decoded_text_are_the_librarys(library, memory):
    for text in [*texts(3, 6_000), *(t or "" for t in AWKWARD), "<s> </s> <unk> <0x0A>", " ", "  a  b ", "▁"]:
        ids = np.frombuffer(memory([text])[0], "<u4").tolist()
        assert ids == library.encode(text), text
        assert memory.encoder.decode(ids) == library.decode(ids).encode(), text


def test_failed_places_are_left_and_long_texts_take_linear_work(library, memory):
    """Runs whose longest pieces do not fit what follows are taken back; no text is quadratic."""
    for text in ("▁" * 17 + "b", "▁" * 33 + "the", "thththe" * 50):
        assert memory.encoder.backtrack(text) == library.encode(text[1:]) if text[0] == "▁" else True
    long = "x" * 200_000 + "日本" * 50_000 + " " * 100_000 + "Ĳ①" * 50_000
    ids = np.frombuffer(memory([long])[0], "<u4").tolist()
    assert ids == library.encode(long)


def test_forgetting_changes_nothing(library, memory, monkeypatch):
    monkeypatch.setattr(b, "MEMORY", 3)
    for text in texts(8, 300):
        assert np.frombuffer(memory([text])[0], "<u4").tolist() == library.encode(text)


def test_documents(spark, library):
    rows = [*AWKWARD, "dup", "dup", *(prose(200, k) for k in range(30))]
    docs = documents(spark, rows).withColumnRenamed("node", "_bytes").withColumnRenamed("kept", "n_tokens").repartition(4)
    got = {r.doc_id: r for r in b.encode_documents(docs, PATH).collect()}
    assert len(got) == len(rows)
    for k, text in enumerate(rows):
        ids = library.encode(text or "")
        assert got[k].n_tokens == len(ids) and np.frombuffer(got[k].ids, "<u4").tolist() == ids
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert b.encode_documents(docs.where("false"), PATH).count() == 0
