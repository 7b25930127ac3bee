import random
import re

from opinara.llm import decontaminate as d
from tests.llm.helpers import AWKWARD, documents, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        own, hit, ids = words(text), set(), set()
        for win, names in windows.items():
            for k in range(len(own) - len(win) + 1):
                if tuple(own[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    ids |= names
        out.append((len(own), len(hit), sorted(ids)))
    return out


def cases():
    r = random.Random(4)
    items = [(k, prose(r.randint(11, 30), k, 30)) for k in range(12)] + [(20, "Short Item é"), (None, "null id item"), (21, None), (22, ""), (23, "short item é")]
    texts = [*AWKWARD, "short  ITEM--é.", "shortitem é", "null id item null id item"]
    for k in range(30):
        item = items[r.randrange(12)][1].upper().replace(" ", ", ")
        cut = item.split(", ")[r.randint(0, 3) :]
        texts.append(prose(40, 90 + k, 30) + "!" + "; ".join(cut) + "? " + prose(5, k, 30))
    return texts + texts[-1:], items


def test_against_brute_force_and_in_blocks(spark):
    texts, items = cases()
    table = spark.createDataFrame([(*i, "clash") for i in items], "item_id int, text string, _runs string")
    for block_bytes in (d.BLOCK_BYTES, 600):
        got = d.contamination(documents(spark, texts), table, block_bytes=block_bytes).orderBy("doc_id").collect()
        for row, (n, hit, ids) in zip(got, brute(texts, items), strict=True):
            assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, hit, len(ids), hit > 0)


def test_runs_map_to_the_original_text():
    scanner = d.Scanner([("q", b"alpha beta gamma")])
    text = "né -- ALPHA;beta\n gamma! alpha beta gamma".encode()
    n, runs, ids = scanner(text)
    assert (n, runs, ids) == (7, [(1, 7)], {"q"})
    assert [text[a:b].decode() for a, b in d.places(text, runs)] == ["ALPHA;beta\n gamma! alpha beta gamma"]


def test_filter_keeps_columns_and_clean_rows(spark):
    texts, items = cases()
    docs = documents(spark, texts)
    table = spark.createDataFrame(items, "item_id int, text string")
    kept = d.decontaminate(docs, table)
    assert kept.columns == docs.columns
    clean = [i for i, (_, hit, _) in enumerate(brute(texts, items)) if not hit]
    assert sorted(r.doc_id for r in kept.collect()) == clean
    assert d.decontaminate(docs, table.where("false")).count() == len(texts)
    assert d.contamination(docs.where("false"), table).count() == 0
