"""Suffix-array dedup: repeats of 200 bytes from merged Burrows-Wheeler transforms.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts elsewhere.

1. Every such string has a least hash among its 32-byte pieces; strings that are equal
   have an equal one. Strings that follow each other and share it make a stretch. A
   stretch whose hash occurs once in the corpus holds no repeat; only the others go on.
2. Stretches with equal text meet as one, with their number as its weight.
3. Stretches of a hash with more than one text are compared. A string with a piece of
   ``SYMBOL`` bytes that occurs once occurs once, so only the runs of other strings go
   on. Their texts are dealt into shards, each with a Burrows-Wheeler transform, and the transforms are merged by
   refining an interleave: each round deals the rows stably by the symbol before them,
   and the borders between unequal prefixes that it finds are the common prefixes. After
   ``LENGTH`` bytes the rows between two borders are the places of one string. No
   suffix of the merged text is sorted again. A symbol is ``SYMBOL`` bytes, so a text
   is that many interleaved strings, and ten rounds compare 200 bytes.
4. The strings found twice or more cover bytes of the stretches, these of the texts.

A hash with very many different texts (a passage that a third of all documents go on
from, each its own way) is not gathered: its strings are counted one by one over the
cluster, by 128 bits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import small_batches, text_bytes
from opinara.session import stage

LENGTH, PIECE, SYMBOL = 200, 32, 20
#: Different stretches of one hash that one task compares at most; beyond it they are counted.
GATHERED = 5_000
#: Bytes of stretches merged at a time, and shards they are dealt into.
BLOCK_BYTES, SHARDS = 1 << 20, 4

_K = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64(17)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolling(data: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each place on (polynomial, by doubling)."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, size, now = factor, 1, data.astype(np.uint64) + np.uint64(1)
    out, done = None, 0
    while size <= length:
        if length & size:  # append this power of two to what is done
            out = now[: len(now)].copy() if out is None else out[: len(now) - done] * power + now[done:]
            done += size
        if 2 * size <= length:
            now = now[:-size] * power + now[size:]
            with np.errstate(over="ignore"):
                power = power * power
        size *= 2
    return _mix(out[:n])


def _least(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least hash among the ``width`` from each place on, and the first place that has it.

    Places are counted within blocks that 17 bits can number with all that their windows
    reach, so that they never wrap inside a window.
    """
    n = max(0, len(h) - width + 1)
    value, place = np.empty(n, np.int64), np.empty(n, np.int64)
    size = 1 << int(_PLACE)
    for begin in range(0, n, size - width + 1):
        least = h[begin : begin + size] >> _PLACE << _PLACE
        least |= np.arange(len(least), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            rest = width - span
            least = np.minimum(least[:-rest], least[rest:])
        value[begin : begin + len(least)] = least >> _PLACE
        place[begin : begin + len(least)] = (least & np.uint64(size - 1)).astype(np.int64) + begin
    return value, place


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash, first and last start of every stretch of the texts, in order."""
    empty = np.empty(0, np.int64)
    long_ = [k for k, t in enumerate(texts) if len(t) >= LENGTH]
    if not long_:
        return empty, empty, empty, empty
    data = np.frombuffer(b"".join(texts[k] for k in long_), np.uint8)
    sizes = np.array([len(texts[k]) for k in long_])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    h = _rolling(data, PIECE, _K)
    # The place breaks ties, so that a run of one least piece is one stretch.
    least, place = _least(h, LENGTH - PIECE + 1)
    owner = np.repeat(np.arange(len(long_)), sizes)[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= ends[owner]
    at = np.flatnonzero(inside)
    place, own = place[at], owner[at]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    local = at - begins[own]
    return (
        np.array(long_)[own[first]], least[at[first]], local[first], local[last],
    )


def _order(symbols: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Suffixes sorted by their symbols, by doubling; every suffix ends in a symbol of its own."""
    rank = symbols.astype(np.int64)
    jump = following
    while True:
        key = rank * np.int64(len(rank) + rank.max() + 2) + rank[jump]
        order = np.argsort(key)  # rows that tie get one rank, so their order is free
        new = np.empty(len(rank), np.int64)
        key = key[order]
        new[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        if new[order[-1]] == len(rank) - 1:
            return order
        rank, jump = new, jump[jump]


class Shard:
    """A Burrows-Wheeler transform over texts, as strings of ``SYMBOL`` bytes a symbol.

    A text of n bytes has n + 1 places; the last ``SYMBOL`` are the ends of its strings,
    each with a symbol that occurs nowhere else. The string before its first symbol is
    its end, so the rows' symbols deal them onto themselves.
    """

    def __init__(self, texts: list[bytes], symbol_of: dict[int, int] | None = None):
        sizes = np.array([len(t) + 1 for t in texts])
        self.begins = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.local = np.arange(int(sizes.sum())) - self.begins[self.owner]
        self.left = sizes[self.owner] - 1 - self.local  # bytes from here on
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        hashes = _rolling(np.concatenate([data, np.zeros(SYMBOL, np.uint8)]), SYMBOL, _K2)[: len(data)]
        self.full = self.left >= SYMBOL
        self.hashes = hashes
        self.check = _rolling(np.concatenate([data, np.zeros(LENGTH, np.uint8)]), LENGTH, _K)[: len(data)]

    def transform(self, symbols: np.ndarray) -> None:
        """Sort the rows by ``symbols`` (of each place) and keep the symbol before each row."""
        places = np.arange(len(symbols))
        following = np.where(self.full, places + SYMBOL, places)
        order = _order(symbols, following)
        phase = self.local % SYMBOL
        size = self.local + self.left
        end = size - (size - phase) % SYMBOL  # the end of the string that starts at this phase
        before = np.where(self.local >= SYMBOL, places - SYMBOL, self.begins[self.owner] + end)
        self.rows, self.symbols = order, symbols[before][order]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard and row of each suffix in merged order, and the number of its LENGTH-byte string.

    Refines the interleave of the shards' transforms LENGTH / SYMBOL times.
    """
    hashes = np.concatenate([s.hashes[s.full] for s in shards])
    _, number = np.unique(hashes, return_inverse=True)
    top, at = int(number.max()) + 1 if len(number) else 0, 0
    for s in shards:
        symbols = np.empty(len(s.full), np.int64)
        n = int(s.full.sum())
        symbols[s.full], number = number[:n], number[n:]
        ends = len(symbols) - n
        symbols[~s.full] = top + at + np.arange(ends)
        at += ends
        s.transform(symbols)
    lengths = [len(s.rows) for s in shards]
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), lengths)
    # A symbol and a place in the interleave share a number, which plain sorting deals
    # stably; there are no more symbols than rows.
    bits = np.uint64(len(source).bit_length())
    lower = (np.uint64(1) << bits) - np.uint64(1)
    places = np.arange(len(source), dtype=np.uint64)
    transforms = np.concatenate([s.symbols for s in shards]).astype(np.uint64) << bits
    block = np.zeros(len(source), np.int32)
    for _ in range(LENGTH // SYMBOL):
        dealt = transforms[_rows(source)] | places
        dealt.sort()
        order = (dealt & lower).view(np.int64)
        source, block = source[order], block[order]
        border = ((dealt[1:] ^ dealt[:-1]) > lower) | (block[1:] != block[:-1])
        block[:1] = 0
        np.cumsum(border, out=block[1:])
    return source, _rows(source) - (np.cumsum(lengths) - lengths)[source], block


def _rows(source: np.ndarray) -> np.ndarray:
    """Where each row's symbol lies among those of all shards: the rows of a shard keep their order."""
    row = np.empty(len(source), np.int64)
    row[np.argsort(source, kind="stable")] = np.arange(len(source))
    return row


def _open(texts: list[bytes], weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last of each run of starts whose strings hold no piece that occurs once.

    A piece is ``SYMBOL`` bytes. A string with a piece that occurs once occurs once; hashes
    that meet by chance only leave more starts open.
    """
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = ends[owner] - np.arange(len(data))
    starts = np.flatnonzero(left >= LENGTH)
    if not len(starts):
        return starts, starts, starts
    places = np.flatnonzero(left >= SYMBOL)
    bits = np.uint64(len(data).bit_length())
    key = _rolling(data, SYMBOL, _K2)[places] >> bits << bits | places.astype(np.uint64)
    key.sort()
    differs = (key[1:] >> bits) != (key[:-1] >> bits)
    alone = np.concatenate([[True], differs]) & np.concatenate([differs, [True]])
    place = (key[alone] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    place = place[np.array(weights)[owner[place]] == 1]
    before = np.zeros(len(data) + 1, np.int32)
    before[place + 1] = 1
    before = np.cumsum(before, dtype=np.int32)
    starts = starts[before[starts + LENGTH - SYMBOL + 1] == before[starts]]
    cut = np.flatnonzero(np.diff(starts) > 1)
    first = starts[np.concatenate([[0], cut + 1])] if len(starts) else starts
    last = starts[np.concatenate([cut, [len(starts) - 1]])] if len(starts) else starts
    begins = ends - sizes
    return owner[first], first - begins[owner[first]], last - begins[owner[first]]


def repeated_starts(texts: list[bytes], weights: list[int], shards: int = SHARDS) -> list[np.ndarray]:
    """Per text the starts of LENGTH-byte strings that occur twice or more in all texts.

    A text counts as often as its weight.
    """
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
    of, first, last = _open(texts, weights)
    if not len(of):
        return out
    # Only runs of open starts are merged, each a text of its own; every open start is in one.
    pieces = [texts[k][a : b + LENGTH] for k, a, b in zip(of.tolist(), first.tolist(), last.tolist(), strict=True)]
    parts = [np.arange(k, len(pieces), shards) for k in range(min(shards, len(pieces)))]
    made = [Shard([pieces[i] for i in p]) for p in parts]
    source, row, block = merge(made)
    lengths = np.array([len(s.rows) for s in made])
    row += (np.cumsum(lengths) - lengths)[source]
    # The end of a shorter string is in a block of its own.
    whole = np.concatenate([s.left[s.rows] >= LENGTH for s in made])[row]
    row, block = row[whole], block[whole]
    piece = np.concatenate([p[s.owner[s.rows]] for s, p in zip(made, parts, strict=True)])[row]
    check = np.concatenate([s.check[s.rows] for s in made])[row]
    text, start = of[piece], first[piece] + np.concatenate([s.local[s.rows] for s in made])[row]
    # A border too where other bits of the string differ: symbols are hashes.
    same = (block[1:] == block[:-1]) & (check[1:] == check[:-1])
    run = np.concatenate([[0], np.cumsum(~same)])
    found = np.bincount(run, weights=np.array(weights)[text])[run] >= 2
    order = np.lexsort((start[found], text[found]))
    own, at = text[found][order], start[found][order]
    for i, part in zip(*_split(own, at), strict=True):
        out[i] = part
    return out


def _split(key: np.ndarray, value: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by (sorted) key."""
    if not len(key):
        return [], []
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    return key[np.concatenate([[0], cut])].tolist(), np.split(value, cut)


def _runs(starts: np.ndarray) -> list[int]:
    """First and last of each run of consecutive starts, flat."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]], 1).ravel().tolist()


def _covered(runs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans, merged, that strings with starts in the runs cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + LENGTH))
        else:
            out.append((a, b + LENGTH))
    return out


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    own = text_bytes(text)
    return docs.select(F.unhex(F.substring(F.sha2(own, 256), 1, 32)).alias("node"), own.alias("text"))


def _suspects(docs: DataFrame, text: str) -> DataFrame:
    """(node, hashes): texts with the hashes of their stretches that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, hashes, _, _ = stretches(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(hashes, pa.int64())], ["node", "hash"])

    every = stage(_keyed(docs, text).mapInArrow(run, "node binary, hash long"), "repeat-hashes")
    # Staged, for Spark splits a hot key of a join only where no aggregate stands before it.
    twice = stage(every.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("hash"), "repeat-twice")
    return every.join(twice, "hash").groupBy("node").agg(F.collect_set("hash").alias("hashes"))


def _stretch_table(docs: DataFrame, text: str) -> DataFrame:
    """(hash, digest, bytes, node, first, copies) of stretches whose hash occurs again."""
    keyed = _keyed(docs, text)
    copies = keyed.select("node").groupBy("node").agg(F.count("*").alias("copies"))
    named = stage(_suspects(docs, text).join(copies, "node"), "repeat-suspects")
    texts = keyed.join(named.select("node", "hashes", "copies"), "node").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name).to_pylist() for name in ("node", "text", "hashes", "copies")}
            wanted = [set(h) for h in at["hashes"]]
            rows = [
                (h, at["text"][k][a : b + LENGTH], at["node"][k], a, at["copies"][k])
                for k, h, a, b in zip(*(x.tolist() for x in stretches(at["text"])), strict=True)
                if h in wanted[k]
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array([hashlib.blake2b(b, digest_size=16).digest() for b in columns[1]], pa.binary()),
                    pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()),
                    pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()),
                ],
                ["hash", "digest", "bytes", "node", "first", "copies"],
            )

    made = texts.mapInArrow(run, "hash long, digest binary, bytes binary, node binary, first long, copies long")
    return stage(made, "repeat-stretches")


def _merged(texts: DataFrame) -> DataFrame:
    """(hash, digest, runs): runs of repeated starts, from merged transforms by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes, int]] = []

        def out(rows: list[tuple[int, bytes, bytes, int]]) -> pa.RecordBatch:
            starts = repeated_starts([r[2] for r in rows], [r[3] for r in rows])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([_runs(s) for s in starts], pa.list_(pa.int64())),
                ],
                ["hash", "digest", "runs"],
            )

        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                # Rows come sorted by hash; a block ends only between two hashes.
                if size >= BLOCK_BYTES and row[0] != last:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[2]), row[0]
        if held:
            yield out(held)

    dealt = texts.select("hash", "digest", "bytes", "weight").repartition("hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(run, "hash long, digest binary, runs array<long>")


def _counted(texts: DataFrame) -> DataFrame:
    """The same rows for hashes with very many texts, by counting strings over the cluster."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (h, d, w, s, hashlib.blake2b(b[s : s + LENGTH], digest_size=16).digest())
                for h, d, b, w in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
                for s in range(len(b) - LENGTH + 1)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["hash", "digest", "weight", "start", "string"],
            )

    each = stage(
        texts.select("hash", "digest", "bytes", "weight").mapInArrow(
            cut, "hash long, digest binary, weight long, start long, string binary"
        ),
        "repeat-strings",
    )
    twice = stage(each.groupBy("string").agg(F.sum("weight").alias("n")).where(F.col("n") > 1).select("string"), "repeat-twice")
    return each.join(twice, "string").groupBy("hash", "digest").agg(
        F.flatten(F.transform(F.sort_array(F.collect_set("start")), lambda s: F.array(s, s))).alias("runs")
    )


def repeated_spans(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(node, spans): per different text the flat first and end byte of each removed span."""
    small_batches(docs.sparkSession, 128)
    table = _stretch_table(docs, text)
    groups = table.groupBy("hash", "digest").agg(F.sum("copies").alias("weight"))
    per_hash = groups.groupBy("hash").agg(F.count("*").alias("kinds"))
    groups = stage(groups.join(per_hash, "hash"), "repeat-groups")
    bytes_of = table.select("hash", "digest", "bytes").join(
        groups.where(F.col("kinds") > 1).select("hash", "digest", "weight", "kinds"), ["hash", "digest"]
    ).dropDuplicates(["hash", "digest"])
    several = stage(bytes_of, "repeat-texts")
    found = stage(_merged(several.where(F.col("kinds") <= GATHERED)), "repeat-runs")
    many = several.where(F.col("kinds") > GATHERED)
    if not many.isEmpty():
        found = found.unionByName(stage(_counted(many), "repeat-runs"))
    # A stretch that is the only text of its hash is a repeat as a whole, or not at all.
    alone = groups.where((F.col("kinds") == 1) & (F.col("weight") > 1)).select("hash", "digest")
    whole = table.select("hash", "digest", "node", "first", F.octet_length("bytes").alias("size")).join(alone, ["hash", "digest"]).select(
        "node", F.array(F.col("first"), F.col("first") + F.col("size") - LENGTH).alias("runs")
    )
    part = table.select("hash", "digest", "node", "first").join(found, ["hash", "digest"]).select(
        "node", F.transform("runs", lambda x: x + F.col("first")).alias("runs")
    )
    own = whole.unionByName(part).where(F.size("runs") > 0).groupBy("node").agg(F.flatten(F.collect_list("runs")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_covered(zip(r[::2], r[1::2], strict=True)) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[x for s in own for x in s] for own in spans], pa.list_(pa.int64()))], ["node", "spans"]
            )

    return stage(own.mapInArrow(run, "node binary, spans array<long>"), "repeat-spans")


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, n_bytes, n_removed, n_spans, kept_sha256, spans, kept.

    ``spans`` are first and end byte of each removed run, ``kept`` (binary, if asked for)
    the other bytes. Equal rows are each other's repeats, so all their bytes go if they
    have LENGTH or more. Null and empty texts and texts shorter than LENGTH lose nothing;
    other columns are left out; an empty table gives no rows.
    """
    spans = repeated_spans(docs, text=text)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), text_bytes(text).alias("text"))
    rows = rows.withColumn("node", F.unhex(F.substring(F.sha2("text", 256), 1, 32))).join(spans, "node", "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column(1).to_pylist(), [s or [] for s in batch.column(2).to_pylist()]
            kept = [
                b"".join(t[a:b] for a, b in zip([0, *s[1::2]], [*s[::2], len(t)], strict=True)) for t, s in zip(texts, removed, strict=True)
            ]
            columns = [
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                pa.array([len(s) // 2 for s in removed], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(removed, pa.list_(pa.int64())),
            ]
            names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_kept:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    more = ", kept binary" if with_kept else ""
    return rows.mapInArrow(
        run, f"`{doc_id}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>{more}"
    )
