"""Sentiment labels from ratings, class ids and class scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.text import no_nan
from opinara.schemas import LABELS

# Decision threshold of the production model and of its challenger.
PRODUCTION_TAU = 0.46
STAGING_TAU = 0.40


def label_from_rating(rating: Column) -> Column:
    """4 and up positive, 2 and down negative, the rest (and no rating) neutral."""
    r = no_nan(rating.cast("double"))
    return F.when(r >= 4, "positive").when(r <= 2, "negative").otherwise("neutral")


def label_from_class(raw: Column) -> Column:
    """Class id to label; anything that is no class id passes through as a string."""
    s = raw.cast("string")
    out = s
    for i, label in reversed(list(enumerate(LABELS))):
        out = F.when(s == str(i), label).otherwise(out)
    return out


def _argmax(scores: list[tuple[str, Column]]) -> Column:
    # First of the best in class order; a missing score never wins.
    best = F.greatest(*[c for _, c in scores]) if len(scores) > 1 else scores[0][1]
    out = F.lit(scores[-1][0])
    for label, c in reversed(scores[:-1]):
        out = F.when(c == best, label).otherwise(out)
    return out


def label_from_scores(scores: Mapping[str, Column], tau: float = PRODUCTION_TAU) -> Column:
    """Negative from ``tau`` up, else the best other class; ``tau`` 0 is plain argmax."""
    ordered = list(scores.items())
    if not tau:
        return _argmax(ordered)
    others = [(label, c) for label, c in ordered if label != "negative"]
    return F.when(scores["negative"] >= F.lit(float(tau)), "negative").otherwise(_argmax(others))
