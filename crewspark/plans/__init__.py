"""Named queries over the workforce tables (registered with their oracles)."""

from __future__ import annotations

from .registry import QUERIES, Query


def all_queries() -> dict[str, Query]:
    """Import every query module once and return the registry."""
    from . import reports, retrieval, staffing  # noqa: F401

    return QUERIES
