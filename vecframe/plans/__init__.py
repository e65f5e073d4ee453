"""Registered queries over the driver tables and their DuckDB oracle SQL."""

from vecframe.plans.registry import QUERIES, ORACLE_SQL, flagship

__all__ = ["QUERIES", "ORACLE_SQL", "flagship"]
