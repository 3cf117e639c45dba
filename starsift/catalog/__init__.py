"""Registered queries: every operator run over the given tables, with its SQL counterpart."""

from __future__ import annotations

from starsift.catalog.registry import ORACLE, QUERIES
from starsift.catalog import (  # noqa: F401  (registration)
    io_queries,
    label_queries,
    model_queries,
    review_queries,
    stat_queries,
    stream_queries,
    text_queries,
)

__all__ = ["ORACLE", "QUERIES"]
