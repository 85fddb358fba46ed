"""Named queries over the given tables and the SQL they are checked against."""

from kinbridge.catalog.oracle import oracle_sql
from kinbridge.catalog.queries import QUERIES

__all__ = ["QUERIES", "oracle_sql"]
