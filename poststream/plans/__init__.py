"""Registered queries (``QUERIES``) and their DuckDB twins (``ORACLE``)."""

from . import classify, dashboard, ingest, streams  # noqa: F401  (registers queries)
from .registry import ORACLE, QUERIES  # noqa: F401
