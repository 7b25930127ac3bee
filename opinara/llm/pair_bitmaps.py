"""Alignment of two tokenizers, with inverted bitmaps of the documents of each pair of ids.

Both tokenizers encode a text with a blank in front; tokens whose byte ranges overlap are
linked. A task numbers the documents of a block and keeps, for each linked pair of ids,
compressed bitmaps of documents: plane ``k`` marks those in which bit ``k`` of the pair's
number of links is set. The planes OR-ed give the documents of the pair, their popcounts
weighted by ``2 ** k`` its links. Counts are summed over blocks; the planes, read as
postings, then carry each pair's score back to its documents.

A bitmap is a sorted list of 16-bit places while that is shorter, else a bit per document.
Only chunks of text are ever aligned, each once while a worker remembers it: at the cuts
between them no token of either tokenizer can reach across.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import small_batches, text_bytes
from opinara.llm.piece_backtrack import BLANK
from opinara.llm.wavelet_tokens import byte_letters
from opinara.session import scratch_path, stage

#: Documents of a block at most: a bit each fits 512 bytes.
BLOCK_DOCS = 4096
#: A block also ends when this many (pair, document) entries are held.
BLOCK_ENTRIES = 2_000_000
#: Bytes of text that are taken at once, or a single longer text.
PART_BYTES = 8 << 20
#: Bytes of chunks that a worker remembers before it begins anew; it holds twice that and
#: two parts' chunks at most. Only speed depends on it.
MEMORY = 64 << 20
#: Chunks that are encoded at once; what the libraries return for one takes about 1 KB.
LEARNT = 8192
#: Bytes of a remembered chunk besides its key's and record's characters.
_ENTRY = 150
#: Behind a character that is no white space both tokenizers end a token before a blank or
#: line break; behind a lone line break before a word; behind any before a blank and a word.
_CUT = re.compile(rf"(?<=[^\s{BLANK}])(?=[ \n])|(?<=\S\n)(?=\S)|(?<=\n)(?= \S)")


def chunks(text: str) -> list[str]:
    """Keys of the parts of a blank and ``text``: a word for itself with its blank, a line
    break and word for both, anything behind a tab for itself."""
    words = text.split()
    if words and BLANK not in text and " ".join(words) == text.replace("\n", " "):
        if "\n" not in text:
            return words
        out = []
        for k, line in enumerate(text.split("\n")):
            own = line.split(" ")
            if k:
                own[0] = "\n" + own[0]
            out += own
        return out
    return ["\t" + c for c in _CUT.split(" " + text) if c]


def chunk_text(key: str) -> str:
    return key[1:] if key[0] == "\t" else key if key[0] == "\n" else " " + key


class Aligned(NamedTuple):
    """A chunk's groups as text, its links as packed codes (A id << 32 | B id), and counts."""

    groups: bytes
    links: bytes
    n_a: int
    n_b: int
    n_groups: int


#: A remembered chunk is one string: n_a, n_b, n_groups and the bytes of its links, the
#: links, the groups. That of a chunk which either side does not give back is empty.
_HEAD = struct.Struct("<4I")
_NONE = _HEAD.pack(0, 0, 0, 0)


def record(e: Aligned | None) -> bytes:
    return b"" if e is None else _HEAD.pack(e.n_a, e.n_b, e.n_groups, len(e.links)) + e.links + e.groups


def _sizes(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(map(len, ids), np.int64, len(ids))


class Aligner:
    """Aligns chunks under tokenizer A (a JSON file's bytes) and B (a piece model's bytes)."""

    def __init__(self, tokenizer: bytes, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        own = {chr(letter): byte for byte, letter in byte_letters().items()}
        entries = json.loads(tokenizer)["model"]["vocab"]
        a_bytes = {i: bytes(map(own.__getitem__, t)) for t, i in entries.items() if own.keys() >= set(t)}
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        pieces = [t for t in map(self.b.id_to_piece, range(self.b.get_piece_size())) if BLANK in t.lstrip(BLANK) or "\n" in t]
        if pieces:
            raise ValueError(f"pieces reach across blanks or line breaks: {pieces[:5]}")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, own)), np.int64) for own in (self.a_bytes, self.b_bytes))
        #: An id as text with what follows it in a group: another id, the other side, or the next group.
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.spelt = [f"{i}{mark}".encode() for mark in ",|;" for i in range(most)]
        self.most = most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def align(self, texts: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[Aligned | None]:
        """Groups and links of each text; None where either side's bytes are not the text's.

        All texts lie on one line of bytes. Ends of tokens of both sides cut it into
        groups, ends of either into pieces, each of which is a link.
        """
        raw = [t.encode() for t in texts]
        fits = [
            b"".join(map(self.a_bytes.__getitem__, a)) == r and b"".join(map(self.b_bytes.__getitem__, b)) == r
            for r, a, b in zip(raw, a_ids, b_ids, strict=True)
        ]
        a_ids = [i for i, ok in zip(a_ids, fits) if ok]
        b_ids = [i for i, ok in zip(b_ids, fits) if ok]
        n_a, n_b = _sizes(a_ids), _sizes(b_ids)
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a_ids, n_a), (b_ids, n_b)))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        every = np.union1d(a_ends, b_ends)
        links = (a[np.searchsorted(a_ends, every)] << 32 | b[np.searchsorted(b_ends, every)]).tobytes()
        # Tokens in order of group and side, each spelt with its mark.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_last, b_last = (np.append(g[1:] != g[:-1], True) for g in (a_group, b_group))
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        spelt = np.concatenate([a + self.most * a_last, b + 2 * self.most * b_last])[order]
        parts = list(map(self.spelt.__getitem__, spelt.tolist()))
        # Where each text's tokens, groups and links end.
        token_ends, text_ends = np.cumsum(n_a + n_b), a_ends[np.cumsum(n_a) - 1] if len(a) else np.zeros(0, np.int64)
        group_ends, link_ends = np.searchsorted(common, text_ends, "right"), np.searchsorted(every, text_ends, "right")
        found, tokens, groups, link = [], 0, 0, 0
        for na, nb, t, g, k in zip(n_a.tolist(), n_b.tolist(), token_ends.tolist(), group_ends.tolist(), link_ends.tolist()):
            found.append(Aligned(b"".join(parts[tokens:t])[:-1], links[8 * link : 8 * k], na, nb, g - groups))
            tokens, groups, link = t, g, k
        own = iter(found)
        return [next(own) if ok else None for ok in fits]

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """B puts a blank in front of what it gets: it stands for the chunk's own, or goes with a line break put behind it."""
        ids = self.b.encode([t[1:] if t[0] == " " and len(t) > 1 else "\n" + t for t in texts], num_threads=1)
        return [i if t[0] == " " and len(t) > 1 else i[2:] for t, i in zip(texts, ids, strict=True)]

    def learn(self, keys: list[str]) -> None:
        texts = list(map(chunk_text, keys))
        a_ids = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        self.known.update(zip(keys, map(record, self.align(texts, a_ids, self.b_ids(texts))), strict=True))

    def recall(self, distinct: set[str]) -> None:
        """Have all these chunks in ``known``. When that is full it becomes the older
        generation, from which chunks still in use are taken over."""
        if self.held > MEMORY:
            self.older, self.known, self.held = self.known, {}, 0
        missing = distinct.difference(self.known)
        met = missing.intersection(self.older)
        self.known.update(zip(met, map(self.older.__getitem__, met)))
        new = list(missing - met)
        for at in range(0, len(new), LEARNT):
            self.learn(new[at : at + LEARNT])
        self.held += sum(map(len, missing)) + sum(map(len, map(self.known.__getitem__, missing))) + _ENTRY * len(missing)

    def __call__(self, texts: list[str]) -> tuple[list[list], np.ndarray, np.ndarray, np.ndarray]:
        """The texts' figures by column; and the links of all texts as (code, text's place, times), each once."""
        cut = [chunks(t) if t else [] for t in texts]
        distinct = set().union(*cut)
        self.recall(distinct)
        distinct = list(distinct)
        known = list(map(self.known.__getitem__, distinct))
        if b"" in known:
            bad = {c for c, e in zip(distinct, known) if not e}
            cut = [[] if bad.intersection(c) else c for c in cut]
            known = [e or _NONE for e in known]
        numbers = np.frombuffer(b"".join([e[: _HEAD.size] for e in known]), "<u4").reshape(-1, 4).T.astype(np.int64)
        ends = (numbers[3] + _HEAD.size).tolist()
        links = b"".join([e[_HEAD.size : end] for e, end in zip(known, ends)])
        spelt = [e[end:] for e, end in zip(known, ends)]
        number = dict(zip(distinct, range(len(distinct)))).__getitem__
        counts = _sizes(cut)
        flat = np.fromiter(map(number, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        sizes = np.concatenate([numbers[:3], numbers[3:] // 8])
        owner = np.repeat(np.arange(len(cut)), counts)
        totals = [np.bincount(owner, sizes[k, flat], len(cut)).astype(np.int64) for k in range(4)]
        spelt = dict(zip(distinct, spelt)).__getitem__
        digests = [hashlib.sha256(b";".join(map(spelt, c))).hexdigest() if c else "" for c in cut]
        # A chunk counts once per text, with its times; then links are spelt out and summed.
        both, times = np.unique(owner * max(1, len(distinct)) + flat, return_counts=True)
        doc, chunk = np.divmod(both, max(1, len(distinct)))
        codes, inverse = np.unique(np.frombuffer(links, np.int64), return_inverse=True)
        per = sizes[3]
        first, spread = np.cumsum(per) - per, per[chunk]
        at = np.repeat(first[chunk] - (np.cumsum(spread) - spread), spread) + np.arange(int(spread.sum()))
        # One integer for code and text sorts faster than two.
        pairs = np.repeat(doc, spread) + inverse[at] * len(cut)
        order = np.argsort(pairs, kind="stable")
        pairs, weights = pairs[order], np.repeat(times, spread)[order]
        at = np.flatnonzero(np.diff(pairs, prepend=-1))
        summed_times = np.add.reduceat(weights, at) if len(at) else weights
        return [*totals, digests], codes[pairs[at] // max(1, len(cut))], pairs[at] % max(1, len(cut)), summed_times


def summed(codes: np.ndarray, docs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ordered by code and document, those of both alike added up."""
    order = np.lexsort((docs, codes))
    codes, docs, times = codes[order], docs[order], times[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    return codes[at], docs[at], np.add.reduceat(times, at) if len(at) else times


def pack(docs: np.ndarray, sizes: np.ndarray, n_docs: int) -> tuple[pa.Array, np.ndarray]:
    """Bitmaps of consecutive runs of sorted documents, and the order they come in.

    Short ones first, as 16-bit places; those of more than a sixteenth of the documents as bits.
    """
    width = -(-n_docs // 8)
    dense = sizes * 2 > width
    owner = np.repeat(np.arange(len(sizes)), sizes)
    listed = docs[~dense[owner]].astype("<u2").tobytes()
    order = np.concatenate([np.flatnonzero(~dense), np.flatnonzero(dense)])
    rank = np.cumsum(dense) - 1
    bits = np.zeros((int(dense.sum()), width * 8), bool)
    marked = dense[owner]
    bits[rank[owner[marked]], docs[marked]] = True
    lengths = np.where(dense[order], width, sizes[order] * 2)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype("<i4")
    data = listed + np.packbits(bits, axis=1, bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)]), order


def unpack(bitmaps: pa.Array, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and documents of all set bits."""
    ends = np.frombuffer(bitmaps.buffers()[1], "<i4")[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    sizes, starts = np.diff(ends), ends[:-1] - ends[0]
    short = np.flatnonzero(~dense)
    keep = np.repeat(~dense, sizes)
    places = np.frombuffer(data[keep].tobytes(), "<u2").astype(np.int64)
    rows, docs = [np.repeat(short, sizes[short] // 2)], [places]
    for row in np.flatnonzero(dense):
        own = np.flatnonzero(np.unpackbits(data[starts[row] : starts[row] + sizes[row]], bitorder="little"))
        rows.append(np.full(len(own), row))
        docs.append(own)
    return np.concatenate(rows), np.concatenate(docs)


def planes(codes: np.ndarray, docs: np.ndarray, times: np.ndarray, n_docs: int) -> Iterator[dict]:
    """Columns of one block's planes: a, b, plane, n_docs, n_links, dense, bitmap.

    ``n_docs``, the popcount of all planes OR-ed, stands on the pair's lowest plane.
    """
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    pair = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    n_of = np.diff(np.append(starts, len(codes)))
    counted = np.zeros(len(starts), bool)
    for k in range(int(times.max()).bit_length() if len(times) else 0):
        has = np.flatnonzero(times >> k & 1)
        if not len(has):
            continue
        own, sizes = np.unique(pair[has], return_counts=True)
        bitmaps, order = pack(docs[has], sizes, n_docs)
        own, sizes = own[order], sizes[order]
        yield {
            "a": codes[starts[own]] >> 32, "b": codes[starts[own]] & 0xFFFFFFFF, "plane": np.full(len(own), k),
            "n_docs": np.where(counted[own], 0, n_of[own]), "n_links": sizes << k,
            "dense": sizes * 2 > -(-n_docs // 8), "bitmap": bitmaps,
        }
        counted[own] = True


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PART_BYTES`` bytes of text."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // PART_BYTES)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)]):
        yield batch.slice(lo, hi - lo)


_ALIGNERS: dict[tuple[int, int], Aligner] = {}


def _aligner(tokenizer: bytes, model: bytes) -> Aligner:
    """The worker's tokenizers and memory, kept between its tasks."""
    key = zlib.crc32(tokenizer), zlib.crc32(model)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(tokenizer, model)
    return _ALIGNERS[key]


_PLANES = "block long, a int, b int, plane int, n_docs long, n_links long, dense boolean, bitmap binary"
_FIGURES = "place int, n_a long, n_b long, n_groups long, n_links_in long, groups_sha256 string"


def align(
    docs: DataFrame, tokenizer_file: str, model_file: str, folder: str | None = None, *, doc_id: str = "doc_id", text: str = "text",
    block_docs: int = BLOCK_DOCS,
) -> tuple[DataFrame, DataFrame]:
    """Align every whole text; return the documents' figures and the pairs' planes.

    The documents: block, place (in the block), ``doc_id``, n_a, n_b, n_groups, n_links,
    groups_sha256. The planes: block, a, b, plane, n_docs, n_links, dense, bitmap. Both
    are read from ``folder`` (or a new one in the shared folder), written in one pass.
    Null and empty texts, and those that either side would not give back byte for byte,
    have no tokens; repeated rows are documents of their own; other columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark, 1024)
    files = []
    for name in (tokenizer_file, model_file):
        with open(name, "rb") as f:
            files.append(spark.sparkContext.broadcast(f.read()))
    folder = folder or scratch_path(spark, "pair-planes")
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), text_bytes(text).alias("bytes"))
    schema = pa.schema(
        [("kind", pa.string()), ("block", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32())]
        + [("n_docs", pa.int64()), ("n_links", pa.int64()), ("dense", pa.bool_()), ("bitmap", pa.binary()), ("doc", pa.null())]
        + [("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
        + [("n_links_in", pa.int64()), ("groups_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _aligner(*(f.value for f in files))
        block, seen, held = TaskContext.get().partitionId() << 32, 0, []

        def table(owner: pa.DataType, n: int, **columns) -> pa.RecordBatch:
            types = [f.with_type(owner) if f.name == "doc" else f for f in schema]
            return pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, f.type) if f.name not in columns
                    else c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)
                    for f in types
                ],
                schema=pa.schema(types),
            )

        def flush(owner: pa.DataType) -> Iterator[pa.RecordBatch]:
            joined = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            for c in planes(*summed(*joined), seen):
                n = len(c["a"])
                yield table(owner, n, kind=["plane"] * n, block=np.full(n, block), **c)

        owner = None
        for batch in chain.from_iterable(map(parts, batches)):
            owner = batch.column(0).type
            n = batch.num_rows
            if seen and (seen + n > block_docs or sum(len(h[0]) for h in held) > BLOCK_ENTRIES):
                yield from flush(owner)
                block, seen, held = block + 1, 0, []
            figures, codes, places, times = work([b.decode("utf-8", "replace") for b in batch.column(1).to_pylist()])
            held.append((codes, (places + seen).astype(np.int32), times.astype(np.int32)))
            yield table(
                owner, n, kind=["doc"] * n, block=np.full(n, block), doc=batch.column(0), place=np.arange(seen, seen + n),
                **dict(zip(("n_a", "n_b", "n_groups", "n_links_in", "groups_sha256"), figures)),
            )
            seen += n
        if seen:
            yield from flush(owner)

    found = rows.mapInArrow(run, f"kind string, {_PLANES}, doc {kind}, {_FIGURES}")
    found.write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    # A table without rows leaves no folders by kind.
    both = spark.read.schema(found.schema).option("basePath", folder).parquet(folder)
    of = lambda name: both.where(F.col("kind") == name)
    figures = of("doc").select(
        "block", "place", F.col("doc").alias(doc_id), "n_a", "n_b", "n_groups", F.col("n_links_in").alias("n_links"), "groups_sha256"
    )
    return figures, of("plane").select("block", "a", "b", "plane", "n_docs", "n_links", "dense", "bitmap")


def pair_counts(pair_planes: DataFrame) -> DataFrame:
    """Per pair of ids: a, b, n_docs, n_links, and best: no A id has more links with this B id."""
    pairs = stage(pair_planes.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")), "pairs")
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))
    return pairs.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def document_scores(pair_planes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per block and place: n_best, count_sum. Each pair's score goes down its planes to the documents.

    Tasks gather whole blocks, whose size ``BLOCK_DOCS`` and ``BLOCK_ENTRIES`` bound.
    """
    small_batches(pair_planes.sparkSession, 20_000)
    # The same plan at every size; a short table of pairs would be broadcast, a long one not.
    scores = pairs.select("a", "b", F.col("n_links").alias("score"), "best").hint("merge")
    scored = pair_planes.join(scores, ["a", "b"])
    dealt = scored.select("block", "plane", "score", "best", "dense", "bitmap").repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, total = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            places = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(places), block)), pa.array(places.astype(np.int32)), pa.array(best[places]), pa.array(total[places])],
                ["block", "place", "n_best", "count_sum"],
            )

        for batch in batches:
            owner = batch.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
            for lo, hi in zip(bounds, bounds[1:]):
                if lo == hi:
                    continue
                if owner[lo] != block:
                    if block is not None:
                        yield out()
                    block, best, total = int(owner[lo]), np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
                part = batch.slice(lo, hi - lo)
                times = np.int64(1) << part.column(1).to_numpy().astype(np.int64)
                dense = part.column(4).to_numpy(zero_copy_only=False)
                rows, docs = unpack(part.column(5), dense)
                np.add.at(total, docs, (times * part.column(2).to_numpy())[rows])
                np.add.at(best, docs, (times * part.column(3).to_numpy(zero_copy_only=False))[rows])
        if block is not None:
            yield out()

    return dealt.mapInArrow(run, "block long, place int, n_best long, count_sum long")


def align_documents(docs: DataFrame, tokenizer_file: str, model_file: str, *, doc_id: str = "doc_id", **names) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair is its B id's most frequent in the corpus, ties
    included; ``count_sum`` adds up the corpus counts of the links' pairs.
    """
    figures, pair_planes = align(docs, tokenizer_file, model_file, doc_id=doc_id, **names)
    scores = document_scores(pair_planes, pair_counts(pair_planes))
    return figures.join(scores, ["block", "place"], "left").select(
        doc_id, "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256",
    )
