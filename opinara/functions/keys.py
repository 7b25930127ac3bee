"""Stable keys from row content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of a seeded order.
ORDER_DIGITS = 15


def content_key(*parts: Column) -> Column:
    """SHA-256 hex of the parts joined by a pipe; a null part counts as empty."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.sha2(F.concat(*pieces), 256)


def review_key(scenario: Column, review_date: Column, text: Column) -> Column:
    """First 16 hex digits of the content key: id of a replayed review."""
    return F.substring(content_key(scenario, review_date, text), 1, 16)


def text_digest(text: Column) -> Column:
    """32-byte stand-in for a long text as a grouping key, so shuffles carry no texts."""
    return F.unhex(F.sha2(text, 256))


def seeded_order(seed: int, key: Column) -> Column:
    """Pseudo-random order of rows that depends on seed and key alone (60 bits, hex)."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, ORDER_DIGITS)
