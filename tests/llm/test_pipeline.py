import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from opinara.llm import byte_bpe
from tests.llm.helpers import prose

BAD = ["grubnik", "snorlop", "vexitude", "blaggard"]


def test_stages_take_effect_in_order(spark, tmp_path):
    r = random.Random(9)
    texts, toxic = [], []
    for k in range(220):
        own = prose(80, k).split()
        bad = k % 5 == 0
        for _ in range(4 if bad else 0):
            own.insert(r.randrange(len(own)), r.choice(BAD))
        texts.append(" ".join(own))
        toxic.append(int(bad))
    item = prose(15, 999)
    texts += [texts[1], texts[2] + " extra", f"{prose(30, 301)} {item} {prose(30, 302)}", "card 4111111111111111 " + prose(60, 303), None, ""]
    toxic += [0] * 6
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    wanted = {i for i, y in enumerate(toxic) if not y} - {220, 221, 222}
    assert set(got) == wanted
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got[1].n_tokens == len(library.encode_ordinary(texts[1]))
    card = byte_bpe.BytePairEncoder(ranks, public_tokenizers.PATTERN).decode(np.frombuffer(got[223].ids, "<u4")).decode()
    assert len(card) == len(texts[223]) and "4111111111111111" not in card and card.endswith(texts[223][21:])
