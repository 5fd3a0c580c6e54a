"""Name of each query to its function and, where SQL can state it, its SQL."""

from __future__ import annotations

from .plans import cards, ingest, reports, retrieval, structure, texts, versions  # noqa: F401
from .plans.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
