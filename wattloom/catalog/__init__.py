"""Named queries over the given tables, each with a SQL statement of the same result."""

from wattloom.catalog.registry import QUERIES, SQL, load_all

__all__ = ["QUERIES", "SQL", "load_all"]
