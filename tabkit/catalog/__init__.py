"""Registered queries: every operator on the given tables, with the SQL that must agree."""

from tabkit.catalog import aggregates, columns, layouts, learning, missing, ordering, sources  # noqa: F401
from tabkit.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
