"""The registered queries: the library's jobs bound to the given tables."""

from wardflow.testbed import files, kpis, relational, texts  # noqa: F401  (they register)
from wardflow.testbed.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
