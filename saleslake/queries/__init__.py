"""Runnable queries over the driver's tables, and their SQL counterparts."""

from saleslake.queries.oracle import oracle_sql
from saleslake.queries.registry import queries

__all__ = ["oracle_sql", "queries"]
