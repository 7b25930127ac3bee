"""Byte-level BPE encoding and decoding with padded numpy matrices.

Pieces of the split pattern are put into buckets by length, each bucket into one padded
matrix of token ids with a row per piece. In every round each row looks up the ranks of
its neighbouring pairs in a hash table, merges the leftmost pair of the smallest rank and
closes the gap; rows without a pair left are done. Pieces longer than ``LONGEST`` bytes
would make quadratic work in a matrix, so they merge the same pairs in the same order
from a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opinara.llm.common import kept, parts, small_batches, text_bytes
from opinara.llm.pieces import ChunkCoder

#: Bytes of the longest piece merged in a matrix.
LONGEST = 192
_NONE = np.int64(1) << 40
_MIX = np.uint64(0x9E3779B97F4A7C15)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token bytes from a rank file: base64 token, blank, rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class PairTable:
    """Pairs of token ids whose joined bytes are a token, in an open-addressing table."""

    def __init__(self, ranks: Mapping[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append((left << 32) | right)
                    values.append(rank)
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, _NONE, np.int64)
        left_keys, left_values = np.array(keys, np.int64), np.array(values, np.int64)
        slots = self._slot(left_keys)
        while len(left_keys):
            # Of the keys that want a free slot the first takes it, the others go one further.
            free = self.keys[slots] < 0
            _, first = np.unique(slots, return_index=True)
            takes = np.zeros(len(slots), bool)
            takes[first] = True
            takes &= free
            self.keys[slots[takes]] = left_keys[takes]
            self.values[slots[takes]] = left_values[takes]
            left_keys, left_values, slots = left_keys[~takes], left_values[~takes], slots[~takes]
            slots = (slots + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a value above every rank."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], _NONE)
        at = np.nonzero((found != keys) & (found >= 0))[0]
        while len(at):
            slots[at] = (slots[at] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[at]]
            hit = found == keys[at]
            out[at[hit]] = self.values[slots[at[hit]]]
            at = at[~hit & (found >= 0)]
        return out.reshape(np.shape(left))


class BytePairEncoder:
    """Encodes pieces and texts by ranks; decodes ids."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        self.ranks = dict(ranks)
        self.pairs = PairTable(ranks)
        self.pattern = regex.compile(pattern)
        self.bytes = np.full(256, -1, np.int64)
        for b in range(256):
            self.bytes[b] = ranks[bytes([b])]
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, packed as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONGEST:
                out[i] = self._long(piece)
            else:
                buckets.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, rows in buckets.items():
            # Bound a matrix to about four million cells.
            step = max(1, (4 << 20) // max(1, width))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        packed = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        column = np.arange(width)
        grid = np.where(column < lengths[:, None], self.bytes[packed], np.int64(-1))
        left = lengths.copy()
        done = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        ranks = np.where(column[1:] < left[:, None], self.pairs(grid[:, :-1], grid[:, 1:]), _NONE)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                ready, size = grid[over].astype("<u4").tobytes(), 4 * grid.shape[1]
                for k, (row, n) in enumerate(zip(rows[over].tolist(), left[over].tolist(), strict=True)):
                    done[row] = ready[k * size : k * size + 4 * n]
                keep = ~over
                grid, left, rows, ranks, at, best = grid[keep], left[keep], rows[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    break
            # Merge, and close the gap by moving everything behind it one to the left.
            behind = column[None, :] > at[:, None]
            moved = np.concatenate([grid[:, 1:], np.full((len(rows), 1), -1)], axis=1)
            grid = np.where(behind, moved, grid)
            k = np.arange(len(rows))
            grid[k, at] = best
            left -= 1
            shifted = np.concatenate([ranks[:, 1:], np.full((len(rows), 1), _NONE)], axis=1)
            ranks = np.where(column[None, :-1] > at[:, None], shifted, ranks)
            # Only the pairs on both sides of the merged token are new.
            has = at > 0
            ranks[k[has], at[has] - 1] = self.pairs(grid[k[has], at[has] - 1], best[has])
            has = at + 1 < left
            ranks[k[has], at[has]] = self.pairs(best[has], grid[k[has], at[has] + 1])
            last = ~has
            inside = last & (at < ranks.shape[1])
            ranks[k[inside], at[inside]] = _NONE
            used = max(2, int(left.max()))
            if used + 4 <= grid.shape[1]:
                grid, ranks, column = grid[:, :used], ranks[:, : used - 1], column[:used]
        return done

    def _long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        pair, ids = self.ranks, [int(self.bytes[b]) for b in piece]
        n = len(ids)
        ends = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = bytearray(b"\1" * n)

        def rank(i: int) -> int | None:
            j = ends[i]
            return pair.get(piece[i : ends[j]]) if j < n else None

        heap = [(r, i, ends[i], ends[ends[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, mid, end = heapq.heappop(heap)
            if not alive[i] or ends[i] != mid or mid >= n or ends[mid] != end or not alive[mid]:
                continue
            alive[mid] = 0
            ids[i], ends[i] = r, end
            if end < n:
                before[end] = i
                if (s := rank(i)) is not None:
                    heapq.heappush(heap, (s, i, end, ends[end]))
            if (p := before[i]) >= 0 and (s := rank(p)) is not None:
                heapq.heappush(heap, (s, p, i, end))
        return np.array([ids[i] for i in range(n) if alive[i]], "<u4").tobytes()

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Packed little-endian ids of chunks; every distinct piece is merged once."""
        find = self.pattern.findall
        # A space and letters are one piece; only other chunks need the pattern.
        cut = [(c,) if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()) else find(c) for c in chunks]
        distinct = list({p: None for ps in cut for p in ps})
        ids = dict(zip(distinct, self.encode_pieces([p.encode() for p in distinct]), strict=True))
        return [ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps]) for ps in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _coder(vocabulary: bytes, pattern: str) -> tuple[BytePairEncoder, ChunkCoder]:
    """The worker's encoder and memory, kept between its tasks."""

    def make() -> tuple[BytePairEncoder, ChunkCoder]:
        encoder = BytePairEncoder(parse_ranks(vocabulary), pattern)
        return encoder, ChunkCoder(encoder.encode_chunks)

    return kept(("byte_bpe", zlib.crc32(vocabulary), pattern), make)


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Encode every whole text, decode it again, and return one row per row of ``docs``.

    Columns: ``doc_id``, n_tokens, ids_sha256 (of the ids as little-endian 32-bit
    integers), decoded_sha256 and, if ``with_ids``, ids (binary, as hashed). No special
    tokens. Null texts are empty; empty texts have no tokens; repeated rows stay; other
    columns are left out; an empty table gives no rows. ``rank_file`` is read by the
    driver (a vocabulary, a few MB whatever the corpus) and broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(rank_file, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    rows = docs.select(f"`{doc_id}`", text_bytes(text).alias("_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, coder = _coder(vocabulary.value, pattern)
        for batch in (part for whole in batches for part in parts(whole, 1)):
            packed = coder([b.decode("utf-8", "replace") for b in batch.column(1).to_pylist()])
            decoded = [hashlib.sha256(encoder.decode(np.frombuffer(p, "<u4"))).hexdigest() for p in packed]
            columns = [
                batch.column(0),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array(decoded),
            ]
            names = [doc_id, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[doc_id].dataType.simpleString()
    ids = ", ids binary" if with_ids else ""
    return rows.mapInArrow(run, f"`{doc_id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{ids}")
