"""The queries of this folder by name; ORACLES holds those that SQL can express."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep
