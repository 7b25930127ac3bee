"""Opinara: customer-review analytics as ordinary Spark jobs."""

from opinara.session import build_session, configure

__all__ = ["build_session", "configure"]
