"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is what merging gives if, and only if, each piece merges to itself
and each two neighbours, merged anew from their characters, stay the same two. So no
merging of whole texts is needed: one Aho-Corasick scan finds the longest piece at every
place, the encoder takes it, and where a piece does not stand behind the one before, the
next shorter prefix is tried; a place from which nothing fits is marked in a bit field
and never entered again. Every place fails once at most, so the work is linear.

Merges go by score and, among equal scores, from the left (runs of blanks share a score).
Characters without a piece become their bytes; no piece reaches across them. Blanks are
written U+2581, and one is put in front of a text that is not empty.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from opinara.llm.common import small_batches, text_bytes

BLANK = "▁"
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Chunks and piece pairs that a worker remembers; only speed depends on them.
MEMORY = 1_200_000


class PieceEncoder:
    """Encodes and decodes texts by the pieces and scores of a merge-type model."""

    def __init__(self, model: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(processor.get_piece_size())
        own = [i for i in every if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))]
        self.texts = {i: processor.id_to_piece(i) for i in own}
        self.scores = {self.texts[i]: processor.get_score(i) for i in own}
        self.byte_ids = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes: dict[int, bytes] = {i: t.replace(BLANK, " ").encode() for i, t in self.texts.items()}
        self.bytes |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.decimal = [str(i).encode() for i in every]
        # Only pieces that merge to themselves can stand in an encoding.
        self.ids = {t: i for i, t in self.texts.items() if self.merge(t) == [t]}
        self.length = {i: len(t) for t, i in self.ids.items()}
        self.shorter = {
            i: next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1)
            for t, i in self.ids.items()
        }
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        letters = "".join(t for t in self.ids if len(t) == 1)
        self.unknown = re.compile(f"([^{re.escape(letters)}])")
        #: Neighbouring characters inside pieces; nothing merges across any other two.
        self.inside = {a + b for t in self.scores for a, b in zip(t, t[1:])}
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """The definition, for texts of a few characters: the best, then leftmost, pair merges until none does."""
        parts = list(text)
        while True:
            found = [(-s, k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if (s := self.scores.get(a + b)) is not None]
            if not found:
                return parts
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces, merged anew from their characters, stay these two."""
        a, b = self.texts[left], self.texts[right]
        if len(self.pairs) > MEMORY:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = a[-1] + b[0] not in self.inside or self.merge(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces."""
        length, shorter, pairs, size = self.length, self.shorter, self.pairs, len(text)
        longest = array("i", bytes(4 * size))
        for last, token in self.automaton.iter(text):
            longest[last + 1 - length[token]] = token
        failed = bytearray((size >> 3) + 1)
        out: list[int] = []
        place, token, before = 0, longest[0] if size else -1, -1
        while place < size:
            end = place + length[token]
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = before < 0 or pairs.get(before << 32 | token)
                if fits is None:
                    fits = self.fits(before, token)
                if fits:
                    out.append(token)
                    place, before = end, token
                    token = longest[place] if place < size else -1
                    continue
            token = shorter[token]
            while token < 0:
                failed[place >> 3] |= 1 << (place & 7)
                token = out.pop()
                place -= length[token]
                token, before = shorter[token], out[-1] if out else -1
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of text with blanks already written as U+2581."""
        parts = self.unknown.split(chunk)
        ids = self.backtrack(parts[0]) if parts[0] else []
        for letter, known in zip(parts[1::2], parts[2::2]):
            ids += [self.byte_ids[b] for b in letter.encode()]
            if known:
                ids += self.backtrack(known)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the text; the blank put in front goes."""
        joined = b"".join(map(self.bytes.__getitem__, ids))
        return joined[1:] if joined[:1] == b" " else joined


def chunks(text: str) -> list[str]:
    """Keys of a text's parts, between which no piece lies.

    No piece holds a blank behind another character, nor a line break. A key without a
    mark stands for itself with one blank before it, one that starts with a line break or
    with a blank for itself.
    """
    if not text:
        return []
    whole = BLANK + text.replace(" ", BLANK)
    dealt = whole.replace("\n", BLANK + "\n")
    if BLANK + BLANK not in dealt and dealt[-1] != BLANK:
        return dealt.split(BLANK)[1:]
    return [c[1:] if c[0] == BLANK and c[1:2] != BLANK else c for c in _CHUNK.findall(whole)]


def chunk_text(key: str) -> str:
    return key if key[:1] in (BLANK, "\n") else BLANK + key


class PieceMemory:
    """Encodes texts to packed ids through a memory of their chunks."""

    def __init__(self, model: bytes):
        self.encoder = PieceEncoder(model)
        inner = [t for t in self.encoder.texts.values() if BLANK in t.lstrip(BLANK) or "\n" in t]
        if inner:
            raise ValueError(f"pieces reach across blanks or line breaks: {inner[:5]}")
        self.known: dict[str, bytes] = {}

    def encode(self, key: str) -> bytes:
        """Packed ids of a chunk; closing marks that nothing merges with are encoded apart, so that fewer chunks are new."""
        encoder, head = self.encoder, key.rstrip(_MARKS)
        if head and len(head) < len(key) and head[-1] + key[len(head)] not in encoder.inside:
            tail = array("I", encoder.encode_chunk(key[len(head) :])).tobytes()
            return (self.known.get(head) or array("I", encoder.encode_chunk(chunk_text(head))).tobytes()) + tail
        return array("I", encoder.encode_chunk(chunk_text(key))).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [chunks(t) for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        known = self.known
        distinct = set().union(*cut)
        for key in sorted(distinct.difference(known), key=len):
            known[key] = self.encode(key)
        # The batch's own words fit the processor's cache, all known ones do not.
        get = {c: known[c] for c in distinct}.__getitem__
        return [b"".join(map(get, keys)) for keys in cut]


_MEMORIES: dict[int, PieceMemory] = {}


def memory(model: bytes) -> PieceMemory:
    """The worker's encoder and memory, kept between its tasks."""
    key = zlib.crc32(model)
    if key not in _MEMORIES:
        _MEMORIES.clear()
        _MEMORIES[key] = PieceMemory(model)
    return _MEMORIES[key]


def encode_documents(
    docs: DataFrame, model_file: str, *, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Encode every whole text, decode it again, and return one row per row of ``docs``.

    Columns: ``doc_id``, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 and, if ``with_ids``, ids (binary, little-endian 32-bit). No begin or
    end ids. Null texts are empty; empty texts have no ids; repeated rows stay; other
    columns are left out; an empty table gives no rows. ``model_file`` is read by the
    driver (a vocabulary, under a MB whatever the corpus) and broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    rows = docs.select(f"`{doc_id}`", text_bytes(text).alias("_bytes"))
    names = [doc_id, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = memory(model.value)
        decode, decimal = encode.encoder.decode, encode.encoder.decimal.__getitem__
        for batch in batches:
            packed = encode([b.decode("utf-8", "replace") for b in batch.column(1).to_pylist()])
            texts, decoded = [], []
            for p in packed:
                ids = np.frombuffer(p, "<u4").tolist()
                texts.append(hashlib.sha256(b",".join(map(decimal, ids))).hexdigest())
                decoded.append(hashlib.sha256(decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(texts), pa.array(decoded)]
            if with_ids:
                columns.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[doc_id].dataType.simpleString()
    ids = ", ids binary" if with_ids else ""
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{ids}")
