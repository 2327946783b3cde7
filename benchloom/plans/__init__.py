"""Registered queries, their inputs and their SQL counterparts."""

from . import (  # noqa: F401
    collect_queries, coverage_queries, evaluate_queries, job_queries, log_queries, patch_queries,
    report_queries, source_queries, split_queries,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
