"""The registered queries: each a callable `(spark, sf_dir)` and the SQL that gives the same rows."""

from tablesync.plans.queries import changes, runs, samples, tables  # noqa: F401
from tablesync.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
