"""Every operator as a named query over the supplied tables, with its SQL twin."""

from gridsight.catalog import clean, features, loads, predictions, star  # noqa: F401
from gridsight.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
