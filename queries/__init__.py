"""Registered queries: the library's operators on the given tables, each with its SQL twin."""

from queries import cleaning, lists, loads, models, pages, quality, reports  # noqa: F401  (they register their queries)
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
