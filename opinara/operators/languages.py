"""Which language a text is in, by character trigrams learnt from rows that say it.

A profile holds the most frequent trigrams of each language, a bounded table however many
rows it is learnt from. A text's score in a language is the sum of the logarithms of its
trigrams' shares there, kept as whole thousandths so that sums are the same in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.quality import ACCEPTED_LANGS, LANG_MIN_SHARE, language_gate
from opinara.session import stage

#: Trigrams kept of each language.
KEPT = 300
_PIECES = r"(?s)(?=(.{1,66})).{1,64}"


def text_grams(df: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` and ``gram``: a row per trigram of the words (runs of letters, in lower case) of whole texts."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1))
    exploded = df.select(*keep, F.explode(words).alias("_word"))
    # Finding a place takes time by its distance from the start, so words are cut into
    # pieces that overlap by two letters: the work is linear for words of any length.
    pieces = F.regexp_extract_all(F.concat(F.lit(" "), "_word", F.lit(" ")), F.lit(_PIECES), F.lit(1))
    cut = exploded.select(*keep, F.explode(pieces).alias("_piece")).where(F.length("_piece") >= 3)
    places = F.sequence(F.lit(1), F.length("_piece") - 2)
    return cut.select(*keep, "_piece", F.explode(places).alias("_at")).select(*keep, F.substr("_piece", "_at", F.lit(3)).alias("gram"))


def learn(df: DataFrame, lang: str = "lang", text: str = "text", kept: int = KEPT) -> DataFrame:
    """The profile: ``lang, gram, weight`` for every language and every trigram that some language keeps.

    Trigrams are counted over all rows; at most ``kept`` of each language, ties in order
    of the trigram, make the profile. Rows without a language are left out.
    """
    rows = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = stage(text_grams(rows, ["lang"]).groupBy("lang", "gram").agg(F.count("*").alias("n")), "grams")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= kept).select("gram").distinct()
    size = best.agg(F.count("*").alias("_size"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_total")).join(F.broadcast(size))
    every = totals.join(best)  # languages by kept trigrams, both bounded
    found = every.join(counts, ["lang", "gram"], "left")
    share = (F.coalesce("n", F.lit(0)) + 1) / (F.col("_total") + F.col("_size"))
    return found.select("lang", "gram", F.round(F.ln(share) * 1000).cast("long").alias("weight"))


def identify(df: DataFrame, profile: DataFrame, key: str, text: str = "text", output: str = "detected") -> DataFrame:
    """``df`` with the likeliest language; null for a text without any known trigram. ``key`` tells rows apart.

    Trigrams meet the profile where they are (it is broadcast: languages by trigrams,
    which ``learn`` bounds) and are summed up per row before the one shuffle by ``key``.
    Ties take the first language by name.
    """
    grams = text_grams(df.select(F.col(key).alias("_key"), F.col(text).alias("text")), ["_key"])
    known = grams.join(F.broadcast(profile), "gram")
    scores = known.groupBy("_key", "lang").agg(F.sum("weight").alias("score"))
    best = scores.groupBy("_key").agg(F.min_by("lang", F.struct(-F.col("score"), "lang")).alias(output))
    return df.join(best, df[key].eqNullSafe(best["_key"]), "left").drop("_key")


def text_language_gate(
    df: DataFrame, profile: DataFrame, key: str, accepted: Sequence[str] = ACCEPTED_LANGS, min_share: float = LANG_MIN_SHARE,
) -> DataFrame:
    """``quality.language_gate`` for rows that do not say their language."""
    return language_gate(identify(df, profile, key, output="_detected"), "_detected", accepted, min_share)
