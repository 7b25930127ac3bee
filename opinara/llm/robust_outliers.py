"""Quality rules: robust multivariate outliers of text statistics.

Per language and source, location and scatter of four transformed statistics come from
the minimum-covariance-determinant estimate: start from medians, keep the half and more
of the rows that lie nearest, estimate anew, and repeat (concentration steps); then
reweight once. Rows whose Mahalanobis distance is beyond a chi-square bound are rejected.

Everything is a DataFrame expression. Statistics are whole numbers, so sums are exact
and the same in any order; quantiles are counted over value histograms, so a group with
a third of all rows is never sorted or collected anywhere.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import stage

_BLANK = r"\x20\x09-\x0D"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
DIMENSIONS = 4
#: Statistics are kept as whole thousandths, distances as whole hundredths up to a bound
#: far beyond every threshold.
_SCALE, _FAR = 1_000, 50_000
#: Rows nearest the centre that an estimate rests on, as a share.
CORE = 0.75
STEPS = 4
#: Least standard deviation of each statistic: most clean texts have no symbol or
#: repeated line at all, and without a floor the first one would be infinitely far.
FLOORS = (0.12, 0.45, 0.45, 0.45)
#: Share of normal rows within the bound.
WITHIN = 0.9995
#: Groups with fewer rows join the rest of their language, then of all.
LEAST = 100


def chi2_within(x: float, dof: int) -> float:
    """Share of a chi-square variable with an even number of degrees below ``x``."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_bound(share: float, dof: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_within(mid, dof) < share else (low, mid)
    return high


def _consistency(share: float) -> float:
    """What a covariance of the nearest ``share`` of normal rows is short of."""
    return share / chi2_within(chi2_bound(share, DIMENSIONS), DIMENSIONS + 2)


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS`` and ``_n_lines``; null texts have no words."""
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(own, "\n", -1), lambda line: line.rlike(f"[^{_BLANK}]"))
    out = docs.withColumns({
        "_words": F.filter(F.split(own, f"[{_BLANK}]+", -1), lambda w: w != ""),
        "_lines": lines,
        "word_chars": F.char_length(F.regexp_replace(own, f"[{_BLANK}]+", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(own, "[^#*$%&|<>]+", "")).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # Windows as 64-bit hashes of their three words.
        "_windows": F.when(
            F.size("_words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 3),
                lambda k: F.xxhash64(F.get("_words", k), F.get("_words", k + 1), F.get("_words", k + 2)),
            ),
        ),
    }).drop("_lines", "_words")
    # Only texts with a window twice sort their windows, with their places.
    out = out.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))),
        ),
    ).drop("_windows")
    again = F.filter(
        "_sorted",
        lambda x, k: (x["h"] == F.get("_sorted", k - 1)["h"]) | (x["h"] == F.get("_sorted", k + 1)["h"]),
    )
    out = out.withColumn("_places", F.sort_array(F.transform(again, lambda x: x["k"]))).drop("_sorted")
    covered = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics: word length, symbols, repeated lines, repeated words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    shares = [
        F.col("word_chars") / words,
        0.01 + F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        0.05 + F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        0.05 + F.col("n_repeat_words") / words,
    ]
    return [F.round(_SCALE * F.log(F.greatest(s, F.lit(1e-3)))).cast("long") for s in shares]


def _quantile(rows: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """Per key the least value with ``share`` of the rows at or below it, by counting."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    up = Window.partitionBy(key).orderBy(value)
    total = F.sum("n").over(Window.partitionBy(key))
    return (
        counts.withColumns({"_up": F.sum("n").over(up), "_all": total})
        .where(F.col("_up") >= share * F.col("_all")).groupBy(key).agg(F.min(value).alias(value))
    )


_X = [f"x{i}" for i in range(DIMENSIONS)]
_PAIRS = list(combinations_with_replacement(range(DIMENSIONS), 2))


def _estimate(rows: DataFrame, factor: float) -> DataFrame:
    """Per key the mean ``m*`` and the Cholesky factor ``l**`` of the scatter, floored."""
    wide = lambda c: c.cast("decimal(20,0)")
    sums = rows.groupBy("key").agg(
        F.count("*").alias("n"),
        *[F.sum(wide(F.col(x))).alias(f"s{i}") for i, x in enumerate(_X)],
        *[F.sum(wide(F.col(_X[i]) * F.col(_X[j]))).alias(f"s{i}{j}") for i, j in _PAIRS],
    )
    d = lambda c: F.col(c).cast("double")
    out = sums.withColumns({f"m{i}": d(f"s{i}") / F.col("n") for i in range(DIMENSIONS)})
    out = out.withColumns({
        f"c{i}{j}": factor * (d(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
        + (F.lit((FLOORS[i] * _SCALE) ** 2) if i == j else F.lit(0.0))
        for i, j in _PAIRS
    })
    for j in range(DIMENSIONS):
        own = F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(own, F.lit(1.0))))
        out = out.withColumns({
            f"l{i}{j}": (F.col(f"c{j}{i}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)))
            / F.col(f"l{j}{j}")
            for i in range(j + 1, DIMENSIONS)
        }) if j + 1 < DIMENSIONS else out
    names = [f"m{i}" for i in range(DIMENSIONS)] + [f"l{j}{i}" for i, j in _PAIRS]
    return stage(out.select("key", *names), "mcd-estimate")


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2``, in whole hundredths."""
    out = rows.join(estimate, "key", "left")
    for i in range(DIMENSIONS):
        moved = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", moved / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") ** 2 for i in range(DIMENSIONS)), F.lit(0.0))
    bounded = F.when(total.isNotNull(), F.least(F.floor(100 * total), F.lit(_FAR)).cast("long"))
    return out.withColumn("d2", bounded).select(*rows.columns, "d2")


def _start(rows: DataFrame) -> DataFrame:
    """Per key medians, and median absolute deviations on the diagonal of ``l**``."""
    parts = []
    for i, x in enumerate(_X):
        middle = _quantile(rows.select("key", x), "key", x, 0.5).withColumnRenamed(x, f"m{i}")
        away = rows.select("key", x).join(middle, "key").select("key", F.abs(F.col(x) - F.col(f"m{i}")).alias("a"))
        spread = _quantile(away, "key", "a", 0.5).select(
            "key", F.sqrt((1.4826 * F.col("a")) ** 2 + (FLOORS[i] * _SCALE) ** 2).alias(f"l{i}{i}")
        )
        parts.append(stage(middle.join(spread, "key"), "mcd-start"))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "key")
    return out.select("*", *[F.lit(0.0).alias(f"l{j}{i}") for i, j in _PAIRS if i != j])


def robust_outliers(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    least: int = LEAST, within: float = WITHIN,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, base_failed, kept, distance.

    ``kept`` is false if base_failed, else whether the squared distance is within the
    chi-square bound. Estimates rest on the rows that did not fail. A language and source
    with fewer than ``least`` such rows are judged with the other small sources of the
    language, these with the small languages; what is fewer still is kept, with a null
    distance. Null languages and sources are groups of their own; null and empty texts have
    no words and fail; repeated rows stay and count; other columns are left out.
    """
    fill = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00"))
    own = docs.select(
        F.col(f"`{doc_id}`").alias("id"), fill(lang).alias("lang"), fill(source).alias("source"),
        F.col(f"`{text}`").alias("text"),
    )
    counted = text_counts(own).withColumn("base_failed", base_failed())
    table = stage(
        counted.select("id", "lang", "source", *COUNTS, "base_failed", *[v.alias(x) for x, v in zip(_X, _vector(), strict=True)]),
        "text-counts",
    )
    good = table.where(~F.col("base_failed"))
    by_source = good.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_source = by_source.withColumn("k", F.when(F.col("n") >= least, F.concat_ws("\x01", "lang", "source")))
    by_lang = by_source.where(F.col("k").isNull()).groupBy("lang").agg(F.sum("n").alias("nl"))
    keys = by_source.join(by_lang, "lang", "left").select(
        "lang", "source",
        F.coalesce("k", F.when(F.col("nl") >= least, F.concat(F.lit("\x02"), "lang")), F.lit("\x03")).alias("key"),
    )
    keys = stage(keys, "mcd-keys")
    rows = good.join(keys, ["lang", "source"]).select("key", *_X)
    enough = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("key")
    rows = stage(rows.join(enough, "key", "left_semi"), "mcd-rows")

    now = _start(rows)
    for step in range(STEPS + 1):
        far = _distance(rows, now)
        if step < STEPS:
            bound = _quantile(far.select("key", "d2"), "key", "d2", CORE).withColumnRenamed("d2", "bound")
            near, share = far.join(bound, "key").where(F.col("d2") <= F.col("bound")), CORE
        else:  # reweighting
            share = 0.975
            near = far.where(F.col("d2") <= int(100 * chi2_bound(share, DIMENSIONS)))
        now = _estimate(near, _consistency(share))
    bound = int(100 * chi2_bound(within, DIMENSIONS))
    judged = _distance(table.join(keys, ["lang", "source"], "left"), now)
    return judged.select(
        F.col("id").alias(doc_id), *COUNTS, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= bound, F.lit(True))).alias("kept"),
        (F.col("d2") / 100).alias("distance"),
    )
