"""The registered queries: every operator on the driver's tables, with SQL giving the same rows where SQL can."""

from tallyframe.suite import records, relational, warehouse  # noqa: F401  (registers the queries)
from tallyframe.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
