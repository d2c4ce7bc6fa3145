"""The expected result of every named query, as SQL for DuckDB over the test tables."""

from .sql import ORACLES

__all__ = ["ORACLES"]
