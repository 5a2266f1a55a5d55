"""Every operator as a query on the given tables, with the SQL that must give the same rows."""

from strata.queries import bronze, checks, gold, incremental, silver, tables, topics  # noqa: F401
from strata.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
