"""Named queries over the driver's tables, each with its SQL counterpart."""

from opinara.catalog import decisions, drift, models, quality, refine, reporting, scalars, sources, streams  # noqa: F401
from opinara.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
