"""Named queries with the SQL that states the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

# Shared views of the SQL side; a statement pulls in what it names.
VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


def with_views(body: str) -> str:
    """Put the needed view definitions, in order, in front of a statement."""
    def names(text: str) -> set[str]:
        return {v for v in VIEWS if re.search(rf"\b{v}\b", text)}
    need, todo = set(), names(body)
    while todo:
        need |= todo
        todo = set().union(*(names(VIEWS[v]) for v in todo)) - need
    if not need:
        return body
    order: list[str] = []

    def place(v: str) -> None:  # after the views that it reads
        if v not in order:
            for w in sorted(names(VIEWS[v]) - {v}):
                place(w)
            order.append(v)
    for v in VIEWS:
        if v in need:
            place(v)
    head = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in order)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a query function under a name, with its SQL when there is one."""
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap
