"""Runnable queries over the stored tables and their SQL counterparts."""

from . import evaluation, searching, tables  # noqa: F401  (fill the registry)
from .registry import QUERIES, SQL, Tables

__all__ = ["QUERIES", "SQL", "Tables"]
