"""Queries over the test tables, one or more per operator, with the SQL they must agree with."""

from lakeops.checks import columns, ingest, maintenance, quality, steps, tables  # noqa: F401
from lakeops.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
