"""The queries of the package, and the same in SQL."""

from tablesift.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
