"""All queries over receipts and logs, and their DuckDB counterparts."""

from . import item_queries, report_queries, source_queries, text_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
