"""All registered queries and their DuckDB oracle SQL, gathered by module."""

from __future__ import annotations

import importlib

MODULES = (
    "marquee.plans.events_queries",
    "marquee.plans.commerce_queries",
    "marquee.plans.flights_queries",
    "marquee.plans.delivery_queries",
)


def _gather():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(m)
        for k in mod.QUERIES:
            if k in queries:
                raise ValueError(f"query {k!r} registered twice")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _gather()[0]


def oracle_sql():
    return _gather()[1]
