"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence
from pathlib import Path
from sys import getsizeof
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import opinara

BATCH_ROWS = 256
BATCH_BYTES = 32 << 20
#: Bytes of text that are taken at once, or a single longer text.
PART_BYTES = 8 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Ready the session for Python tasks over texts.

    Arrow batches get at most ``rows`` rows and, but for a single longer row, about
    ``BATCH_BYTES`` bytes, so that very long texts fit a worker. Workers
    on this machine find the package where the driver found it; on other machines it is
    installed or given with ``--py-files``, as any package.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(opinara.__file__).parents[1]))


class Memory:
    """Values by key that a worker remembers, bounded in bytes; only speed depends on it.

    When ``most`` bytes are held they become the older generation, from which keys still
    in use are taken over; so it holds twice that and the keys of two calls at most.
    """

    #: Bytes of a dictionary by key.
    ENTRY = 100

    def __init__(self, most: int):
        self.most = most
        self.known: dict = {}
        self.older: dict = {}
        self.held = 0

    def get(self, key):
        return self.known.get(key, self.older.get(key))

    def recall(self, keys: set, learn: Callable[[list], dict]) -> dict:
        """Values of all ``keys`` and others; ``learn`` gives those of keys not remembered, or more."""
        if self.held > self.most:
            self.older, self.known, self.held = self.known, {}, 0
        missing = keys.difference(self.known)
        if missing:
            found = {k: self.older[k] for k in missing if k in self.older}
            if len(found) < len(missing):
                found |= learn(list(missing.difference(found)))
            self.known.update(found)
            self.held += sum(map(getsizeof, found)) + sum(map(getsizeof, found.values())) + self.ENTRY * len(found)
        return self.known


_KEPT: dict[Hashable, Any] = {}


def forget() -> None:
    """Drop what the worker keeps: Spark lends one worker to the tasks of one operator after another."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What the worker keeps between its tasks under ``key``; a single thing at a time."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PART_BYTES`` bytes in a binary column."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = (np.flatnonzero(np.diff(ends // PART_BYTES)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(ends)] if len(ends) else []):
        yield batch.slice(lo, hi - lo)


def text_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


def free_name(name: str, docs: DataFrame) -> str:
    """``name``, lengthened until no column of ``docs`` has it, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tables(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]
