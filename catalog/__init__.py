"""Queries over the test tables, each with the SQL that says what it must return."""

from catalog import (  # noqa: F401
    check_queries,
    cleaning_queries,
    intake_queries,
    load_queries,
    record_queries,
    row_queries,
    schema_queries,
    source_queries,
)
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
