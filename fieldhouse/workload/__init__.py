"""Registered queries over the given tables, each with its DuckDB counterpart where SQL can say it."""

from fieldhouse.workload import betting, cleaning, comparison, encoding, features, metrics, models, nested, stores, tables  # noqa: F401
from fieldhouse.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
