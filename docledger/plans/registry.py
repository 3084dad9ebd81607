"""Where registered queries and their DuckDB equivalents are kept."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) -> DataFrame under its name."""

    def wrap(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return wrap
