"""Queries over the test tables, each with the SQL that gives the same rows."""

from catalog.base import ORACLES, QUERIES
from catalog import jobs, routing, sampling, scalars, sources, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
