"""Registered queries of the reference's own operators, with their DuckDB equivalents.

All read the given tables whole. Amounts are summed as decimals, so that a sum doesn't depend on its order.
"""

from __future__ import annotations

from . import audits, catalogs, files, front, layouts, operations, publishing, qualities, releases, scalars, serving, sheets, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
