"""Near-duplicates by order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with how often it came
before, so that repeats stay apart. A sketch draws the shingles with the smallest hashes
under its own order and keeps them in text order: equal sketches need the same shingles
in the same order, so they follow edit similarity rather than sets. Texts that share a
sketch are candidates. A pair with a text of ``SHORT`` shingles or fewer is found exactly
instead: sketches would miss many, for such texts have few shingles to draw from. By the
prefix filter of similarity joins, linked texts share a shingle among the first of each in
hash order, as many as a link may leave unmatched and one more; each of these is a key.

A pair is a link if the alignment of its shingle sequences, within the band that the
threshold allows, matches m shingles with m / (a + b - m) >= 0.8. Classes are the
connected components of links; equal texts are one class to begin with and meet as one.

In a bucket every text is aligned with a representative, not with every other: first
with the text that has most of the shingles many texts share, which is the centre of a
group of copies, then with another. Buckets whose texts then lie in several classes are
searched for the links left without comparing all their pairs. Call a shingle common if
more than ``COMMON`` candidate texts have it. Two linked texts either share a rare
shingle, even one among the first fifth of their rare ones in hash order (the prefix
filter of similarity joins), or their common shingles alone reach the number of matches
that a link needs; the first are joined on rare shingles, each in at most ``COMMON``
texts, the second within their bucket. So a bucket of n near copies costs about n
alignments, no bucket is capped or cut, and no link between two texts that share a
key is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import Memory, forget, kept, small_batches, text_bytes
from opinara.session import stage

WORDS = 5
SIMILARITY = 0.8
#: Sketches of a text, and shingles in a sketch. A pair with similarity 0.8 shares a
#: sketch with a chance of about 0.8 ** 6, so it is missed with 6 in 100,000 if it is
#: long; drawing without replacement makes that 21 in 100,000 just beyond ``SHORT``.
SKETCHES, DRAWN = 32, 6
#: Texts of so many shingles or fewer meet by shingles instead, which misses none.
SHORT = 30
STARS = 2
COMMON = 64

_ODD = np.random.default_rng(20_26).integers(1, 1 << 63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def shingles(words: list[bytes]) -> list[tuple[bytes, ...]]:
    """Every run of five words; a shorter text is one shingle, a text without words none."""
    if len(words) < WORDS:
        return [tuple(words)] if words else []
    return list(zip(*(words[k:] for k in range(WORDS)), strict=False))


class Sketcher:
    """Hashed shingles and sketches of texts, through a memory of word hashes."""

    #: In bytes.
    MEMORY = 32 << 20

    def __init__(self) -> None:
        self.memory = Memory(self.MEMORY)

    @staticmethod
    def learn(new: list[bytes]) -> dict[bytes, int]:
        return dict(zip(new, map(xxhash.xxh64_intdigest, new)))

    def items(self, words: list[bytes]) -> np.ndarray:
        """A 64-bit hash of each shingle and its occurrence, in text order."""
        if not words:
            return np.empty(0, np.uint64)
        known = self.memory.recall(set(words), self.learn)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        s = np.zeros(n, np.uint64)
        for k in range(min(WORDS, len(h))):
            s = _mix(s * _STEP + h[k : k + n])
        order = np.argsort(s, kind="stable")
        run = np.concatenate([[True], s[order][1:] != s[order][:-1]])
        if not run.all():  # label each shingle with its occurrence
            first = np.maximum.accumulate(np.where(run, np.arange(n), 0))
            again = np.empty(n, np.uint64)
            again[order] = (np.arange(n) - first).astype(np.uint64)
            s = _mix(s + again * _STEP)
        return s

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """One 64-bit key per sketch; none for a text without words."""
        return self.sketch(self.items(words))

    def keys(self, words: list[bytes], similarity: float = SIMILARITY) -> np.ndarray:
        """What candidates share: first shingles if one of them can be short, else sketches."""
        s = self.items(words)
        n, per = len(s), round(similarity * 1000)
        if n * per > SHORT * 1000:  # too long for a link with a short text
            return self.sketch(s)
        first = np.sort(s)[: n - -(-n * per // 1000) + 1].view(np.int64)
        return first if n <= SHORT else np.concatenate([first, self.sketch(s)])

    def sketch(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        if not n:
            return np.empty(0, np.int64)
        drawn = min(DRAWN, n)
        ranks = s[None, :] * _ODD[:, :1] ^ _ODD[:, 1:]
        least = np.argpartition(ranks, drawn - 1, axis=1)[:, :drawn] if drawn < n else np.tile(np.arange(n), (SKETCHES, 1))
        picked = s[np.sort(least, axis=1)]
        key = np.arange(SKETCHES, dtype=np.uint64)
        for k in range(drawn):
            key = _mix(key * _STEP + picked[:, k])
        return key.view(np.int64)


def matched(a: list, b: list, band: int) -> int:
    """Length of the longest alignment of equal items whose places differ by ``band`` at most.

    One bit per item of ``b``; a row of the alignment table is one addition.
    """
    lead = 0
    while lead < min(len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[lead : len(a) - tail], b[lead : len(b) - tail]
    if not a or not b:
        return lead + tail
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    strip = (1 << (2 * band + 1)) - 1
    row = full
    for i, x in enumerate(a):
        hit = places.get(x, 0)
        if hit:
            hit &= strip << (i - band) if i >= band else strip >> (band - i)
            up = row & hit
            row = ((row + up) | (row - up)) & full
    return lead + tail + len(b) - row.bit_count()


def linked(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    """Whether two shingle sequences align at the similarity or more."""
    if not a or not b:
        return False
    total = len(a) + len(b)
    # m / (total - m) >= s  <=>  m >= s * total / (1 + s); what is outside bounds the band.
    least = int(-(-round(similarity * 1000) * total // round((1 + similarity) * 1000)))
    if min(len(a), len(b)) < least:
        return False
    own = set(b)
    if sum(x in own for x in a) < least:
        return False
    return matched(a, b, total - 2 * least) >= least


def _node(text: str) -> Column:
    """128 bits of SHA-256: equal texts are one node."""
    return F.unhex(F.substring(F.sha2(text_bytes(text), 256), 1, 32))


def _long_enough(a: str, b: str, similarity: float) -> Column:
    least, most = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return least * 1000 >= most * round(similarity * 1000)


def _sketch_table(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), _node(text).alias("node"), text_bytes(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = kept("order_minhash", Sketcher)
        for batch in batches:
            sizes, keys = [], []
            for t in batch.column(2).to_pylist():
                words = t.split()
                sizes.append(len(words) and max(1, len(words) - WORDS + 1))
                keys.append(sketcher.keys(words, similarity))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "node", "n", "sketches"],
            )

    return stage(rows.mapInArrow(run, f"id {kind}, node binary, n long, sketches array<long>"), "omh-sketches")


def _texts(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, text) of the candidate nodes, gathered once for all rounds."""
    keyed = docs.select(_node(text).alias("node"), text_bytes(text).alias("text"))
    wanted = nodes.hint("merge")  # sorts spill, hash tables do not
    return stage(keyed.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "omh-texts")


def _common(texts: DataFrame) -> DataFrame:
    """(node, common, rare): the number of a text's common shingles, and its first rare ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = kept("order_minhash", Sketcher)
        for batch in batches:
            items = [sketcher.items(t.split()).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.list_(pa.int64()))], ["node", "items"])

    items = stage(texts.select("node", "text").mapInArrow(run, "node binary, items array<long>"), "omh-items")
    each = items.select("node", F.explode("items").alias("item"))
    many = each.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") > COMMON).select("item", F.lit(True).alias("many"))
    marked = each.join(many, "item", "left").groupBy("node").agg(
        F.count("*").alias("n"), F.count("many").alias("common"),
        F.sort_array(F.collect_list(F.when(F.col("many").isNull(), F.col("item")))).alias("rare"),
    )
    return stage(
        marked.select("node", "common", F.slice("rare", F.lit(1), F.ceil(F.col("n") / 5).cast("int") + 1).alias("rare")), "omh-rare"
    )


def _left_over(now: DataFrame, open_: DataFrame, common: DataFrame, similarity: float) -> DataFrame:
    """(a, b, n_a, n_b): pairs across classes that can still be links."""
    left = now.join(open_.select("key"), "key", "left_semi").join(common.drop("rare"), "node")
    # Enough common shingles for a link with a text of the least length that can be one.
    dense = left.where(F.col("common") * 1000 >= F.col("n") * round(similarity * 1000))

    def side(df: DataFrame, on: str, x: str) -> DataFrame:
        columns = {"node": x, "cls": f"cls_{x}", "n": f"n_{x}", "common": f"common_{x}"}
        return df.select(on, *[F.col(c).alias(to) for c, to in columns.items() if c in df.columns])

    enough = F.least("common_a", "common_b") * round((1 + similarity) * 1000) >= (F.col("n_a") + F.col("n_b")) * round(similarity * 1000)
    by_common = side(dense, "key", "a").join(side(dense, "key", "b"), "key").where((F.col("cls_a") < F.col("cls_b")) & enough)
    nodes = left.select("node", "cls", "n").distinct()
    rare = nodes.join(common, "node").select("node", "cls", "n", F.explode("rare").alias("item"))
    by_rare = side(rare, "item", "a").join(side(rare, "item", "b"), "item").where(F.col("cls_a") < F.col("cls_b"))
    columns = ["a", "b", "n_a", "n_b"]
    return by_common.select(*columns).unionByName(by_rare.select(*columns))


def _aligned(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes that are links; every pair is aligned once."""
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        last, own = None, []
        for batch in batches:
            keep = []
            for a, x, y in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if a != last:
                    last, own = a, shingles(x.split())
                keep.append(linked(own, shingles(y.split()), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def _components(links: DataFrame) -> DataFrame:
    """(node, cls) of every node in ``links``: the least node of its component.

    Every class takes the least class that it is linked to, until none is linked to
    another. Nodes are hashes, so chains along their order are short.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(nodes.withColumn("cls", F.col("node")), "omh-classes")
    edges = stage(links.select("a", "b"), "omh-edges")
    while True:
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = ways.groupBy("a").agg(F.min("b").alias("to")).where(F.col("to") < F.col("a"))
        to = stage(to, "omh-moves")
        if to.isEmpty():
            return labels
        move = lambda df, c: df.join(to.select(F.col("a").alias(c), "to"), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        labels = stage(move(labels, "cls"), "omh-classes")
        edges = stage(move(move(edges, "a"), "b").where(F.col("a") != F.col("b")).distinct(), "omh-edges")


def _classified(docs: DataFrame, doc_id: str, text: str, similarity: float, stars: int) -> DataFrame:
    """(id, node, class_id, class_size, n_links, kept) per row of ``docs``."""
    small_batches(docs.sparkSession)
    table = _sketch_table(docs, doc_id, text, similarity)
    with_words = table.where(F.col("n") > 0)
    # Equal texts meet as one node: partial aggregation comes before the shuffle.
    nodes = with_words.groupBy("node").agg(F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    buckets = nodes.select("node", "n", F.explode("sketches").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1).select("key")
    buckets = stage(buckets.join(shared, "key"), "omh-buckets")

    texts = _texts(docs, text, buckets.select("node").distinct())
    common = _common(texts)
    buckets = stage(buckets.join(common.select("node", "common"), "node"), "omh-buckets")

    classes = tested = links = None
    for step in range(stars + 1):
        now = buckets
        if classes is None:
            now = now.withColumn("cls", F.col("node"))
        else:
            now = now.join(classes, "node", "left").withColumn("cls", F.coalesce("cls", "node"))
        # The most central text of a bucket first, then any other.
        central = F.struct(F.col("common") if step == 0 else F.lit(0), F.sha2(F.concat(F.lit(str(step).encode()), "node"), 256).alias("o"))
        open_ = now.groupBy("key").agg(
            F.min("cls").alias("low"), F.max("cls").alias("high"), F.max_by(F.struct("node", "cls", "n"), central).alias("rep")
        ).where(F.col("low") != F.col("high"))
        if step < stars:
            star = open_.select("key", F.col("rep.node").alias("a"), F.col("rep.cls").alias("cls_a"), F.col("rep.n").alias("n_a"))
            met = now.join(star, "key").where(F.col("cls") != F.col("cls_a")).select("a", F.col("node").alias("b"), "n_a", F.col("n").alias("n_b"))
        else:
            met = _left_over(now.drop("common"), open_, common, similarity)
        pairs = met.where(_long_enough("n_a", "n_b", similarity)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "omh-pairs")
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stage(_aligned(pairs, texts, similarity), "omh-links")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            classes = _components(links)

    rows = table.select("id", "node", "n")
    if classes is None:
        rows = rows.withColumns({"cls": F.col("node"), "n_links": F.lit(0).cast("long")})
    else:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        rows = rows.join(classes.join(degree, "node", "left"), "node", "left").select(
            "id", "node", "n", F.coalesce("cls", "node").alias("cls"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
        )
    sizes = rows.where(F.col("n") > 0).groupBy("cls").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.where(F.col("n") > 0).join(sizes, "cls").select(
        "id", "node", "class_id", "class_size", "n_links", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    ).unionByName(
        rows.where(F.col("n") == 0).select(
            "id", "node", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), "n_links",
            F.lit(True).alias("kept"),
        )
    )


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, stars: int = STARS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, class_id, class_size, n_links, kept.

    ``class_id`` is the least id of the class, ``class_size`` its rows, ``n_links`` the
    links found between the row's text and different texts, and ``kept`` marks the row
    with the least id (of rows with that same id, all). Words are what white space
    parts. Null and empty texts and texts of white space only are no duplicates: each
    such row is a class of its own, with its own id. Null ids count as greater than
    others; other columns are left out.
    """
    return _classified(docs, doc_id, text, similarity, stars).drop("node").withColumnRenamed("id", doc_id)


def drop_near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, stars: int = STARS,
) -> DataFrame:
    """``docs`` with one row of each class, that of its least id; same columns.

    Rows with the same id and text are one. Rows without words all stay, but for such copies.
    """
    kept = _classified(docs, doc_id, text, similarity, stars).where("kept").select(
        F.col("id").alias("_kept_id"), F.col("node").alias("_kept_node")
    )
    kept = stage(kept.distinct(), "omh-kept")
    # The document as one column: no name of its own meets one of these.
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col(f"`{doc_id}`").alias("id"),
        _node(text).alias("node"),
    )
    return (
        own.join(kept, F.col("id").eqNullSafe(F.col("_kept_id")) & (F.col("node") == F.col("_kept_node")), "left_semi")
        .dropDuplicates(["id", "node"]).select("document.*")
    )
