"""DuckDB twins of the catalogue queries."""

from oracles.queries import oracle_sql

__all__ = ["oracle_sql"]
