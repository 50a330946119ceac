"""Registered queries over the given tables and the SQL they are compared with."""

from catalog import marts, operations, serving, stored  # noqa: F401  (register their queries)
from catalog.registry import registered as all_queries
from catalog.registry import registered_sql as all_sql

__all__ = ["all_queries", "all_sql"]
