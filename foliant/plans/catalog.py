"""All registered queries over the star-schema and document tables."""

from __future__ import annotations

from foliant.plans import assembly_queries, document_queries, grammar_queries, grid_queries, markup_queries, package_queries, record_queries, suite_queries, table_queries, vector_queries  # noqa: F401
from foliant.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
