"""Text and number expressions (Column in, Column out)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.fixed import (
    BRAND_ALIASES,
    CHAIN_TERMS,
    EMOJI_POLARITY,
    GENERIC_TERMS,
    LETTER,
    MISSING_TOKENS,
    NON_SPACE,
    PUNCTUATION,
    SPACES,
    TOKEN,
    WORD,
)


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(c, F.lit(SPACES))


def not_blank(c: Column) -> Column:
    """True for a string with at least one visible character; false for null."""
    return F.coalesce(c.rlike(NON_SPACE), F.lit(False))


def has_letter(c: Column) -> Column:
    return c.rlike(LETTER)


def text_length(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit("")))


def number(c: Column) -> Column:
    """String to double, null when it is not a plain number. NaN becomes null."""
    s = strip(c.cast("string"))
    plain = s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, s.try_cast("double"))


def no_nan(c: Column) -> Column:
    """NaN to null; null stays null."""
    return F.when(~F.isnan(c), c)


def missing_to_null(c: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def comma_set(c: Column) -> Column:
    """Comma-separated string to its trimmed, non-empty parts; null to none."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip)
    return F.filter(parts, lambda p: p != "")


def overlaps(parts: Column, wanted: Sequence[str]) -> Column:
    """Do the parts name any wanted value? Nothing wanted means everything is."""
    if not wanted:
        return F.lit(True)
    return F.arrays_overlap(parts, F.array(*[F.lit(w) for w in wanted]))


def city_state(city: Column, state: Column) -> Column:
    both = (city != "") & (state != "")
    return F.when(both, F.concat(city, F.lit(", "), state)).otherwise(city)


def name_pattern(generic: Sequence[str] = GENERIC_TERMS, chains: Sequence[str] = CHAIN_TERMS) -> str:
    # (?U): word boundaries and case follow Unicode on every Java version.
    return rf"(?iU)\b(?:{'|'.join(generic)})\b|(?:{'|'.join(chains)})"


def name_in_scope(name: Column, keywords: Sequence[str] | None = None) -> Column:
    """Whole generic terms or chain names; ``keywords`` replaces both by substrings."""
    if keywords:
        low = F.lower(name)
        hit = F.lit(False)
        for word in sorted({k.lower() for k in keywords}):
            hit = hit | low.contains(word)
    else:
        hit = name.rlike(name_pattern())
    return F.coalesce(hit, F.lit(False))


def alias_pattern(aliases: Sequence[str] = BRAND_ALIASES) -> str:
    longest_first = sorted(aliases, key=len, reverse=True)
    return rf"(?iU)\b(?:{'|'.join(longest_first)})\b"


def rename_brands(c: Column, brand: str, aliases: Sequence[str] = BRAND_ALIASES) -> Column:
    return F.regexp_replace(c, alias_pattern(aliases), brand)


# Punctuation and blanks as one class of listed characters, cheaper than Unicode's own.
_BLANKS = "".join(f"\\x{{{ord(ch):x}}}" for ch in SPACES)
_SQUEEZED = f"[{_BLANKS}{PUNCTUATION}]+"
_EMOJI = "[" + "".join(sorted({symbol[0] for symbol in EMOJI_POLARITY})) + "]"


def normalise(c: Column) -> Column:
    """Lower-case, drop links and mentions, spell out emoji, blank punctuation, squeeze.

    Texts without a link, a mention or an emoji skip that pass.
    """
    low = F.lower(c)
    has_link = F.contains(low, F.lit("://")) | F.contains(low, F.lit("www."))
    t = F.when(has_link, F.regexp_replace(low, r"(?U)(?:https?://|www\.)[^\s\x1c-\x1f]+", " ")).otherwise(low)
    t = F.when(F.contains(c, F.lit("@")), F.regexp_replace(t, rf"@{WORD}+", " ")).otherwise(t)
    spelled = t
    for symbol, polarity in EMOJI_POLARITY.items():
        spelled = F.replace(spelled, F.lit(symbol), F.lit(f" {polarity} "))
    # Plain ASCII has no emoji to look for.
    t = F.when((F.octet_length(c) != F.length(c)) & c.rlike(_EMOJI), spelled).otherwise(t)
    return F.trim(F.regexp_replace(t, _SQUEEZED, " "))


def words(c: Column) -> Column:
    """Lower-cased ASCII words of three letters or more."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def printable(c: Column) -> Column:
    """Is anything left once control characters and blanks are dropped?"""
    return F.coalesce(c.rlike(r"[^\p{C}\p{Z}]"), F.lit(False))


def snippet(c: Column, size: int = 200) -> Column:
    cut = F.substring(c, 1, size)
    return F.when(F.length(c) > size, F.concat(cut, F.lit("…"))).otherwise(cut)


def bucket_of_url(c: Column) -> Column:
    return F.regexp_extract(c, r"^s3://([^/]*)", 1)


def key_of_url(c: Column) -> Column:
    return F.regexp_extract(c, r"^s3://[^/]*/(.*)$", 1)
