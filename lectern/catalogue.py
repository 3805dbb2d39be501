"""All queries over the driver's relational tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import audit, boxes, closures, compare, flow, groups, headings, items, marking, mentions, ordered, pages, reconcile, running, schemes, textual

MODULES = (reconcile, groups, ordered, textual, audit, pages, marking, schemes, closures, items, running, boxes, compare, flow, mentions, headings)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
