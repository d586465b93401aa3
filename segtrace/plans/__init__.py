"""Jobs, and the registered queries with their SQL."""

from . import format_queries, job_queries, queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "format_queries", "job_queries", "queries"]
