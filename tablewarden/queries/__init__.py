"""Queries over the test tables, one or more an operator."""

from . import audit, cleaning, joining, loading, privacy, quality, shapes, streams  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
