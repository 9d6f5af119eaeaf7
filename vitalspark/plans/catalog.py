"""All registered queries (importing the plan modules fills the registry)."""

from __future__ import annotations

from . import document_queries, io_queries, reading_queries, stats_queries, stream_queries  # noqa: F401
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
