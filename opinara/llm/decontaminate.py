"""Benchmark decontamination with one Aho-Corasick automaton.

Items (questions, answers) are normalised to words; every run of ``width`` words, or a
shorter item whole, is a pattern " w1 w2 ... " of the automaton. Each text is normalised
the same way and read once; a match gives the words it covers, and the words give the
places in the original text. Work is per document: no shuffle, no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import forget, free_name, small_batches, text_bytes

WIDTH = 10
#: Bytes of item texts in one automaton. More items make further automata, each read by
#: a pass of its own, so that neither the driver nor a worker holds more than this.
BLOCK_BYTES = 1 << 20

# Lower-cases A-Z and turns every byte outside words into a blank; bytes of 0x80 and more are word bytes.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def patterns(items: list[tuple[str, bytes]], width: int = WIDTH) -> dict[bytes, tuple[int, set[str]]]:
    """Number of words and item ids by pattern."""
    out: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        own = words(text)
        n = min(width, len(own))
        for at in range(len(own) - n + 1 if own else 0):
            key = b" " + b" ".join(own[at : at + n]) + b" "
            out.setdefault(key, (n, set()))[1].add(item)
    return out


class Scanner:
    """The automaton over items, and the scan of one text."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WIDTH):
        self.machine = ahocorasick.Automaton()
        for key, (n, ids) in patterns(items, width).items():
            self.machine.add_word(key.decode("latin-1"), (n, sorted(ids)))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def __call__(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, runs of hit words as (first, end), ids of items found."""
        own = words(text)
        if self.empty or not own:
            return len(own), [], set()
        flat = b" " + b" ".join(own) + b" "
        ids: set[str] = set()
        found: list[tuple[int, int]] = []
        for end, (n, items) in self.machine.iter(flat.decode("latin-1")):
            found.append((end, n))
            ids.update(items)
        if not found:
            return len(own), [], ids
        blanks = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
        ends = np.searchsorted(blanks, [e for e, _ in found])
        return len(own), merge((int(e) - n, int(e)) for e, (_, n) in zip(ends, found, strict=True)), ids


def merge(runs) -> list[tuple[int, int]]:
    """Overlapping or touching runs joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def places(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of runs of words."""
    if not runs:
        return []
    spans = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    return [(spans[a][0], spans[b - 1][1]) for a, b in runs]


_HITS = T.StructType([
    T.StructField("_n_words", T.LongType()),
    T.StructField("_runs", T.ArrayType(T.LongType())),
    T.StructField("_items", T.ArrayType(T.StringType())),
])


def _item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), text_bytes(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total * 2 // block_bytes if total > block_bytes else 1
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"] if r["item"] is not None else "", bytes(r["text"])) for r in part.collect()]


def scan(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with three columns more: ``_n_words``, ``_runs`` and ``_items``.

    ``_runs`` holds first and end word of each run of hit words, flat and in order;
    ``_items`` the sorted distinct ids. Columns of these names in ``docs`` are replaced,
    all others stay, repeated rows too. Null and empty texts have no words and no hits.
    Null and empty items match nothing, an item with a null id counts under "". Without items
    nothing is hit. Items of up to ``block_bytes`` bytes are one automaton.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = free_name("_bytes", docs)
    out = docs.withColumn(own, text_bytes(text)).drop("_n_words", "_runs", "_items")
    kept, fields = out.columns, out.schema.fields
    for k, block in enumerate(_item_blocks(items, item_id, item_text, block_bytes)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=k > 0) -> Iterator[pa.RecordBatch]:
            forget()
            scanner = Scanner(shared.value, width)
            for batch in batches:
                found = [scanner(b) for b in batch.column(own).to_pylist()]
                if again:  # join what earlier automata found
                    before = zip(batch.column("_runs").to_pylist(), batch.column("_items").to_pylist(), strict=True)
                    found = [
                        (n, merge([*runs, *zip(had[::2], had[1::2], strict=True)]), ids.union(names))
                        for (n, runs, ids), (had, names) in zip(found, before, strict=True)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.select(kept).columns,
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array([[x for r in runs for x in r] for _, runs, _ in found], pa.list_(pa.int64())),
                        pa.array([sorted(ids) for _, _, ids in found], pa.list_(pa.string())),
                    ],
                    [*kept, "_n_words", "_runs", "_items"],
                )

        out = out.mapInArrow(run, T.StructType([*fields, *_HITS.fields]))
    return out.drop(own)


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", **names) -> DataFrame:
    """Per document: ``doc_id``, n_words, n_hit, n_items, items_sha256, contaminated, runs."""
    hits = scan(docs, items, **names)
    pairs = F.sequence(F.lit(0), F.size("_runs") - 2, F.lit(2))
    return hits.select(
        F.col(f"`{doc_id}`"),
        F.col("_n_words").alias("n_words"),
        F.when(F.size("_runs") == 0, F.lit(0)).otherwise(
            F.aggregate(pairs, F.lit(0).cast("long"), lambda n, k: n + F.get("_runs", k + 1) - F.get("_runs", k))
        ).cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_runs") > 0).alias("contaminated"),
        F.col("_runs").alias("runs"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", **names) -> DataFrame:
    """``docs`` without the documents in which an item's window occurs; same columns."""
    # The document as one column: no name of its own meets one of the scan's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col(f"`{text}`").alias("text"))
    return scan(rows, items, text="text", **names).where(F.size("_runs") == 0).select("document.*")
