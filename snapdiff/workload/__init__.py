"""Queries over the given tables, one or more per operator."""

from . import cleaning, deltas, functions, io, jobs, quality  # noqa: F401  (register their queries)
from .registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
