"""Named queries: each operator bound to the given tables, with a SQL twin."""

from __future__ import annotations

from importlib import import_module

from ledgerlark.plans.registry import QUERIES, Query

_MODULES = (
    "selection",
    "joining",
    "aggregation",
    "ranking",
    "subqueries",
    "scalars",
    "changes",
    "quality",
    "reshaping",
    "searching",
    "layouts",
    "timelines",
)


def all_queries() -> dict[str, Query]:
    """Every named query, in the order of the modules."""
    for module in _MODULES:
        import_module(f"ledgerlark.plans.{module}")
    return QUERIES
