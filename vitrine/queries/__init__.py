"""Registered queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from vitrine.queries.registry import QUERIES, SQL
from vitrine.queries import catalogue, flows, model, monitor, runs, training  # noqa: F401  (they register)

__all__ = ["QUERIES", "SQL"]
