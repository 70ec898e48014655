"""Registered queries: import the modules so their decorators run."""

from . import batch_queries, drift_queries, ml_queries, payload_queries, runlog_queries, stream_queries, window_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
