"""The register of this subpackage's queries."""

from __future__ import annotations

from paperloom.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where SQL can express it."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register
