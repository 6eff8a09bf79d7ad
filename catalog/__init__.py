"""The library's operators as queries over the driver's tables, each with its SQL oracle."""

from catalog import bronze, landed, legislature, marts, operators, tables
from catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "bronze", "landed", "legislature", "marts", "operators", "tables"]
