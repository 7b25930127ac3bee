"""Token ids in one wavelet matrix per shard.

A shard holds the ids of consecutive documents. Bit-plane by bit-plane, highest bit
first, the ids are kept as one bit each and dealt stably into zeros, then ones. With a
directory of ones before each block, ``access``, ``rank``, ``select`` and ``count`` work
on the packed planes alone.

Layout of a shard, little-endian: the magic bytes, then as 64-bit integers the number
of ids, of planes and of documents; the number of zeros of each plane; the planes, each
packed eight ids a byte from the lowest bit and padded to eight bytes; the first id's
place of each document. A shard is the single row of one Parquet file, compressed there.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import small_batches, text_bytes
from opinara.llm.pieces import chunks
from opinara.session import scratch_path

MAGIC = b"WVLTIDS1"
END = 0
_END = END.to_bytes(4, "little")
#: Ids of a shard at most, if no single document has more.
SHARD_IDS = 1 << 22
BLOCK = 512


class WaveletMatrix:
    """Ids as bit-planes; built from an array or read from a shard's bytes."""

    def __init__(self, n: int, zeros: np.ndarray, planes: list[np.ndarray], starts: np.ndarray):
        self.n, self.zeros, self.planes, self.starts = n, zeros, planes, starts
        self._ones: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, starts: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        zeros, planes = np.zeros(depth, np.int64), []
        for k in range(depth):
            bit = (now & now.dtype.type(1 << (depth - 1 - k))).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            planes.append(np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]))
            # Places, then take: several times faster than masks, which branch on each bit.
            low = np.flatnonzero(~bit)
            zeros[k] = len(low)
            now = np.concatenate([now.take(low), now.take(np.flatnonzero(bit))])
        return cls(len(ids), zeros, planes, np.asarray(starts, np.int64))

    def dump(self) -> bytes:
        head = np.array([self.n, len(self.planes), len(self.starts)], "<i8")
        return b"".join(
            [MAGIC, head.tobytes(), self.zeros.astype("<i8").tobytes()]
            + [p.tobytes() for p in self.planes] + [self.starts.astype("<i8").tobytes()]
        )

    @classmethod
    def load(cls, data: bytes) -> WaveletMatrix:
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        n, depth, docs = np.frombuffer(data, "<i8", 3, 8).tolist()
        zeros = np.frombuffer(data, "<i8", depth, 32)
        at, size = 32 + 8 * depth, -(-n // 64) * 8
        planes = [np.frombuffer(data, np.uint8, size, at + k * size) for k in range(depth)]
        return cls(n, zeros, planes, np.frombuffer(data, "<i8", docs, at + depth * size))

    def _before(self, plane: int, place: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        if self._ones is None:
            self._ones = [
                np.concatenate([[0], np.cumsum(np.add.reduceat(np.bitwise_count(p), np.arange(0, len(p), BLOCK // 8), dtype=np.int64))])
                if len(p) else np.zeros(1, np.int64)
                for p in self.planes
            ]
        place = np.asarray(place, np.int64)
        block = place // BLOCK
        out = self._ones[plane][block].copy()
        bits = self.planes[plane]
        for k, (b, x) in enumerate(zip(block.tolist(), place.tolist(), strict=True)):
            lo, whole = b * (BLOCK // 8), x // 8
            out[k] += int(np.bitwise_count(bits[lo:whole]).sum())
            if x % 8:
                out[k] += (int(bits[whole]) & ((1 << (x % 8)) - 1)).bit_count()
        return out

    def access(self, places) -> np.ndarray:
        """Ids at places."""
        at = np.atleast_1d(np.asarray(places, np.int64)).copy()
        out = np.zeros(len(at), np.int64)
        for k, bits in enumerate(self.planes):
            one = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            ones = self._before(k, at)
            at = np.where(one == 1, self.zeros[k] + ones, at - ones)
            out = (out << 1) | one
        return out

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        """Where ``value`` of places start..end lies behind the last plane."""
        depth = len(self.planes)
        if value >> depth or value < 0:
            return 0, 0
        for k in range(depth):
            ones = self._before(k, np.array([start, end]))
            if value >> (depth - 1 - k) & 1:
                start, end = (int(self.zeros[k] + x) for x in ones)
            else:
                start, end = int(start - ones[0]), int(end - ones[1])
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often ``value`` occurs at places start..end."""
        lo, hi = self._range(value, start, self.n if end is None else end)
        return hi - lo

    rank = count

    def select(self, value: int, nth: int) -> int:
        """Place of the nth occurrence of ``value``, from 0."""
        lo, hi = self._range(value, 0, self.n)
        if not 0 <= nth < hi - lo:
            raise IndexError("no such occurrence")
        at, depth = lo + nth, len(self.planes)
        for k in range(depth - 1, -1, -1):
            one = bool(value >> (depth - 1 - k) & 1)
            want = at - int(self.zeros[k]) if one else at
            low, high = 0, self.n  # the place whose bit is the (want + 1)th of its kind
            while low < high:
                mid = (low + high) // 2
                ones = int(self._before(k, np.array([mid + 1]))[0])
                if (ones if one else mid + 1 - ones) <= want:
                    low = mid + 1
                else:
                    high = mid
            at = low
        return at

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def ids(self) -> np.ndarray:
        """All ids in order: the deals of the planes undone from the last to the first."""
        depth = len(self.planes)
        kind = np.uint16 if depth <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for k in range(depth - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            out = np.empty_like(now)
            out[np.flatnonzero(~bit)] = now[: self.zeros[k]]
            out[np.flatnonzero(bit)] = now[self.zeros[k] :] | kind(1 << (depth - 1 - k))
            now = out
        return now

    def slice(self, document: int) -> tuple[int, int]:
        """Places of a document's ids."""
        end = self.starts[document + 1] if document + 1 < len(self.starts) else self.n
        return int(self.starts[document]), int(end)


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


_BYTE_LETTERS = byte_letters()
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class LibraryCoder:
    """Packed ids as the library gives them, through a memory of chunks.

    The chunks of all plain texts of a batch are looked up together, by their bytes as
    numbers. Of new ones, words of letters go to the library's model in its byte alphabet,
    without the offsets that an encoding works out; marks behind letters are pieces of
    their own; others go through the full encoder. A text that holds the string of an
    added token is encoded by the library as a whole, as added tokens are cut out before
    anything else; unless they count as ordinary text.
    """

    def __init__(self, vocabulary: bytes, added_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary.decode())
        self.library.encode_special_tokens = added_as_text
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (added_as_text and t.special)]
        self.known: dict[str, bytes] = {}
        self.table = ChunkTable()

    def full(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(self, ids: list[list[int]]) -> list[bytes]:
        sizes = list(map(len, ids))
        flat = np.fromiter(chain.from_iterable(ids), "<u4", sum(sizes)).tobytes()
        ends = [0, *accumulate(4 * n for n in sizes)]
        return [flat[lo:hi] for lo, hi in pairwise(ends)]

    def words(self, words: list[bytes]) -> list[bytes]:
        """Of blanks with letters behind them."""
        model = self.library.model
        spelt = [w.decode("latin-1").translate(_BYTE_LETTERS) for w in words]
        return self.packed([[t.id for t in ts] for ts in map(model.tokenize, spelt)])

    def parts(self, texts: list[str]) -> list[bytes]:
        return self.packed(self.full(texts))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.encode_bytes([t.encode() for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of UTF-8 texts. Chunks of plain texts are looked up all together."""
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(list(map(len, texts)), out=starts[1:])
        joined = b"".join(texts) + bytes(WIDTH)
        data = np.frombuffer(joined, np.uint8)
        plain = _plain(data, starts)
        for k in _holding(joined, starts, self.added):
            plain[k] = False
        bounds = _chunk_bounds(data, starts, plain)
        own = plain[np.searchsorted(starts, bounds[:-1], "right") - 1]
        entries = np.zeros(len(own), np.int64)
        entries[own] = self.table.find(joined, data, bounds[:-1][own], np.diff(bounds)[own], self.chunk_ids)
        ids, ends = self.table.ids(entries)
        # A text's ids end where its chunks do.
        edges = ends[np.searchsorted(bounds, starts)].tolist()
        out = [ids[lo:hi].tobytes() if ok else b"" for lo, hi, ok in zip(edges, edges[1:], plain.tolist())]
        others = [k for k, ok in enumerate(plain.tolist()) if not ok]
        for k, p in zip(others, self.encode_other([texts[k].decode("utf-8", "replace") for k in others]), strict=True):
            out[k] = p
        return out

    def chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of new chunks of plain texts: a word with the blank or line break before it, if any."""
        words, tails, rest = [], {}, []
        for k, chunk in enumerate(chunks):
            text = chunk.decode("utf-8", "replace")
            if text[0] == " " and text[1:].isalpha():
                words.append((k, chunk))
                continue
            head = text.rstrip(_MARKS)
            if head[:1] == " " and head[1:].isalpha():
                tails[k] = text[len(head) :]
                words.append((k, chunk[: len(chunk) - len(tails[k])]))
            else:
                rest.append((k, text))
        new = list(set(tails.values()).difference(self.known))
        self.known.update(zip(new, self.parts(new), strict=True))
        out = dict(zip((k for k, _ in rest), self.parts([t for _, t in rest]), strict=True))
        out |= zip((k for k, _ in words), self.words([w for _, w in words]), strict=True)
        for k, tail in tails.items():
            out[k] += self.known[tail]
        if len(self.known) > LEARNT:
            self.known.clear()
        return [out[k] for k in range(len(chunks))]

    def encode_other(self, texts: list[str]) -> list[bytes]:
        """Texts with other white space, or with the string of an added token, which is encoded whole."""
        cut = [[t] if any(a in t for a in self.added) else [c[1:] if c[0] == "\t" else c if c[0] == "\n" else " " + c for c in chunks(t)] for t in texts]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        known = dict(zip(distinct, self.parts(distinct), strict=True))
        return [b"".join(map(known.__getitem__, cs)) for cs in cut]


#: Bytes of a chunk that is looked up by its bytes as numbers; longer ones go by a dictionary.
WIDTH = 24
#: Chunks that a worker's dictionaries and table remember; only speed depends on them.
LEARNT, TABLED = 200_000, 2_600_000
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_MIXES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BLANK, _OTHER, _LEAD = 1, 2, 3
#: Blanks and line breaks cut; other white space and zeros, and letters that may start a wide blank, are told apart.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[32, 10]] = _BLANK
_KINDS[[0, 9, 11, 12, 13, 28, 29, 30, 31]] = _OTHER
_KINDS[[0xC2, 0xE1, 0xE2, 0xE3]] = _LEAD


def _holding(joined: bytes, starts: np.ndarray, strings: list[str]) -> set[int]:
    """The texts that hold one of the strings."""
    found = set()
    for own in map(str.encode, strings):
        at = joined.find(own)
        while at >= 0:
            found.add(int(np.searchsorted(starts, at, "right")) - 1)
            at = joined.find(own, at + 1)
    return found


def _plain(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts have no white space but single blanks and line breaks between words."""
    kinds = _KINDS[data]
    wrong = [np.flatnonzero(kinds == _OTHER)]
    leads = np.flatnonzero(kinds == _LEAD)
    if len(leads):
        wide = data[leads].astype(np.int64) << 16 | data[leads + 1].astype(np.int64) << 8 | data[leads + 2]
        two = wide >> 8
        blank = (two == 0xC285) | (two == 0xC2A0) | (wide == 0xE19A80) | (wide == 0xE2819F) | (wide == 0xE38080)
        blank |= (two == 0xE280) & ((wide & 0xFF <= 0x8A) | np.isin(wide & 0xFF, [0xA8, 0xA9, 0xAF]))
        wrong.append(leads[blank])
    seps = np.flatnonzero(kinds == _BLANK)
    wrong.append(seps[1:][np.diff(seps) == 1])
    plain = np.ones(len(starts) - 1, bool)
    at = np.concatenate(wrong)
    plain[np.searchsorted(starts, at[at < starts[-1]], "right") - 1] = False
    some = np.flatnonzero(np.diff(starts) > 0)
    plain[some[(kinds[starts[some]] == _BLANK) | (kinds[starts[some + 1] - 1] == _BLANK)]] = False
    return plain


def _chunk_bounds(data: np.ndarray, starts: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Where chunks start, and where the last ends; a text that is not plain is one chunk, which is not looked up."""
    cuts = _KINDS[data[: starts[-1] + 1]] == _BLANK
    if not plain.all():
        cuts &= np.append(np.repeat(plain, np.diff(starts)), False)
    cuts[starts] = True
    return np.flatnonzero(cuts)


class ChunkTable:
    """Entries of packed ids by a chunk's bytes, in an open-addressing table of numbers."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.slots = np.zeros((1 << (3 * TABLED // 2).bit_length(), 4), np.uint64)
        self.shift = np.uint64(64 - (len(self.slots).bit_length() - 1))
        self.long: dict[bytes, int] = {}
        # Entry 0 is no ids.
        self.starts, self.sizes, self.flat = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, "<u4")
        self.used = 0

    def add(self, packed: list[bytes]) -> np.ndarray:
        """New entries of packed ids."""
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        first = len(self.sizes)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(packed), "<u4")])
        return np.arange(first, first + len(packed))

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the entries in order, and where each entry's begin and the last's end."""
        sizes = self.sizes[entries]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[entries] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.flat[at], ends

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys * _MIXES).sum(axis=1, dtype=np.uint64)
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _MIXES[0]) >> self.shift).astype(np.int64)

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, 0 if there is none."""
        places = self._places(keys)
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        while len(left):
            rows = self.slots[places]
            same = (rows[:, :3] == keys[left]).all(axis=1)
            out[left[same]] = rows[same, 3].astype(np.int64)
            on = ~same & (rows[:, 3] > 0)
            left, places = left[on], (places[on] + 1) & (len(self.slots) - 1)
        return out

    def _put(self, keys: np.ndarray, entries: np.ndarray) -> None:
        """Distinct keys that are not in the table."""
        places = self._places(keys)
        while len(keys):
            _, first = np.unique(places, return_index=True)
            takes = np.zeros(len(keys), bool)
            takes[first] = True
            takes &= self.slots[places, 3] == 0
            self.slots[places[takes], :3] = keys[takes]
            self.slots[places[takes], 3] = entries[takes]
            keys, entries, places = keys[~takes], entries[~takes], (places[~takes] + 1) & (len(self.slots) - 1)

    def find(self, joined: bytes, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, encode: Callable) -> np.ndarray:
        """The entry of each chunk; new ones are encoded once."""
        if self.used > TABLED:
            self.forget()
        words = np.ndarray((len(data) - 7,), "<u8", joined, 0, (1,))
        short = sizes <= WIDTH
        at, n = starts[short], sizes[short]
        keys = np.stack([words[at + k] & _MASKS[np.clip(n - k, 0, 8)] for k in (0, 8, 16)], axis=1)
        found = self._look(keys)
        new = np.flatnonzero(found == 0)
        if len(new):
            order = new[np.lexsort(keys[new].T)]
            step = np.ones(len(order), bool)
            step[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
            one = order[step]
            entries = self.add(encode([joined[s : s + m] for s, m in zip(at[one].tolist(), n[one].tolist())]))
            self._put(keys[one], entries.astype(np.uint64))
            self.used += len(one)
            found[order] = entries[np.cumsum(step) - 1]
        out = np.zeros(len(starts), np.int64)
        out[short] = found
        if not short.all():
            where = np.flatnonzero(~short)
            own = [joined[s : s + m] for s, m in zip(starts[where].tolist(), sizes[where].tolist())]
            fresh = list(dict.fromkeys(c for c in own if c not in self.long))
            if fresh:
                self.long.update(zip(fresh, self.add(encode(fresh)).tolist(), strict=True))
                self.used += len(fresh)
            out[where] = [self.long[c] for c in own]
        return out


_CODERS: dict[tuple[int, bool], LibraryCoder] = {}


def _coder(vocabulary: bytes, added_as_text: bool = False) -> LibraryCoder:
    """The worker's tokenizer and memory, kept between its tasks."""
    key = zlib.crc32(vocabulary), added_as_text
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = LibraryCoder(vocabulary, added_as_text)
    return _CODERS[key]


def write_shards(
    docs: DataFrame, tokenizer_file: str, folder: str, *, doc_id: str = "doc_id", text: str = "text",
    shard_ids: int = SHARD_IDS, added_as_text: bool = False,
) -> None:
    """Encode whole texts, end each with id 0, and write the shards in ascending doc_id order.

    Each row of the written table is a shard in a file of its own: part and seq (their
    order is document order), doc_ids, n_ids and the matrix's bytes. Null doc_ids come
    first, ties of doc_id in any order; null and empty texts are the end id alone;
    repeated rows stay. A document never spans two shards, so one of more than
    ``shard_ids`` ids makes a longer shard. A text that spells an added token gets its id,
    as from the library, or, with ``added_as_text``, the ids of ordinary text. The tokenizer's file (a few MB whatever the corpus) is broadcast by the driver.
    """
    spark = docs.sparkSession
    small_batches(spark, 1024)
    with open(tokenizer_file, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), text_bytes(text).alias("bytes"))
    # Dealt by ranges of doc_id before encoding, so that the range sample reads no tokens.
    dealt = rows.repartitionByRange("doc").sortWithinPartitions("doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq = _coder(vocabulary.value, added_as_text), TaskContext.get().partitionId(), 0
        ids, owners, starts, held = [], [], [], 0

        def shard() -> pa.RecordBatch:
            whole = WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u4"), np.array(starts))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([owners], pa.list_(owner)),
                    pa.array([held], pa.int64()), pa.array([whole.dump()], pa.binary()),
                ],
                ["part", "seq", "doc_ids", "n_ids", "matrix"],
            )

        owner = None
        for batch in batches:
            owner = batch.column(0).type
            packed = coder.encode_bytes(batch.column(1).to_pylist())
            for doc, p in zip(batch.column(0).to_pylist(), packed, strict=True):
                n = len(p) // 4 + 1
                if held and held + n > shard_ids:
                    yield shard()
                    seq, ids, owners, starts, held = seq + 1, [], [], [], 0
                ids += (p, _END)
                owners.append(doc)
                starts.append(held)
                held += n
        if held:
            yield shard()

    shards = dealt.mapInArrow(run, f"part int, seq int, doc_ids array<{kind}>, n_ids long, matrix binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(folder)


def read_shards(shards: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """Per document of the shards: ``doc_id``, start, n_tokens, ids_crc32, in no order.

    ``start`` counts the ids of all documents before it. The ids come from the planes.
    """
    spark = shards.sparkSession
    small_batches(spark, 1)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                matrix = WaveletMatrix.load(batch.column(3)[k].as_buffer())
                view = memoryview(matrix.ids().astype("<u4")).cast("B")
                bounds = [*matrix.starts.tolist(), matrix.n]
                owners = batch.column(2)[k].values
                yield pa.RecordBatch.from_arrays(
                    [
                        owners,
                        pa.repeat(batch.column(0)[k], len(owners)),
                        pa.repeat(batch.column(1)[k], len(owners)),
                        pa.array(bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([zlib.crc32(view[4 * x : 4 * y]) for x, y in pairwise(bounds)], pa.int64()),
                    ],
                    ["doc", "part", "seq", "inner", "n_tokens", "ids_crc32"],
                )

    documents = shards.select("part", "seq", "doc_ids", "matrix").mapInArrow(
        run, f"doc {kind}, part int, seq int, inner long, n_tokens long, ids_crc32 long"
    )
    # Ids before a shard: those of the parts before (a row per part), and of its part's shards before.
    sizes = shards.select("part", "seq", "n_ids")
    before_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start")
    )
    in_part = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    places = sizes.withColumn("shard_start", in_part).join(before_part, "part")
    return documents.join(places, ["part", "seq"]).select(
        F.col("doc").alias(doc_id),
        (F.col("part_start") + F.col("shard_start") + F.col("inner")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_file_digest(docs: DataFrame, tokenizer_file: str, folder: str | None = None, **names: str) -> DataFrame:
    """Write the shards to ``folder`` (or a new one in the shared folder) and read them back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    write_shards(docs, tokenizer_file, folder, **names)
    return read_shards(spark.read.parquet(folder), doc_id=names.get("doc_id", "doc_id"))
