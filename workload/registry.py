"""Registered queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = (fn, sql)
        return fn

    return add
