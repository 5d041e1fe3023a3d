"""Queries over the given tables that exercise every operator, with their SQL twins."""

from tidemark.checks import changes, flows, layout, scans  # noqa: F401 - registers its queries
from tidemark.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
