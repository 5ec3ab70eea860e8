"""Runnable queries over the test tables."""

from . import (  # noqa: F401
    dimension_queries, finance_queries, keys_upsert, operations_queries, receivables_queries, relational,
    sales_queries, sources_ingest, stock_queries)
from .core import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
