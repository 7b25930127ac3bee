"""Documents with every awkward case, shared by the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, node string, id long"


def documents(spark, texts, start=0):
    """A table of documents with columns whose names the operators use themselves."""
    rows = [
        (start + i, t, "en" if i % 3 else None, f"src{i % 2}", None if t is None else len(t), 9.0, "x", "n", 7)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def prose(n, seed=0, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 8))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "a  b \n c", "\x1c \x85x é", "日本語 テキスト", "x" * 30_000, prose(4_000, 3)]
