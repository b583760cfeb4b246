"""All registered queries."""

from . import layer_queries, load_queries, payload_queries, report_queries  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
