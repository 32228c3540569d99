"""The registry that pairs each query with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genoweave.plans.inputs import Inputs, view_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named oracle subqueries: (views or subqueries they need, SELECT).
SUBQUERIES: dict[str, tuple[str, str]] = {}


def _needed(names: str, found: list[str]) -> list[str]:
    for name in names.split():
        if name in SUBQUERIES:
            _needed(SUBQUERIES[name][0], found)
        if name not in found:
            found.append(name)
    return found


def _oracle(names: str, select: str) -> str:
    parts = []
    for name in _needed(names, []):
        body = SUBQUERIES[name][1] if name in SUBQUERIES else view_sql(name)
        parts.append(f"{name} as ({body})")
    if not parts:
        return select
    more = f", {select[5:]}" if select.startswith("with ") else f" {select}"
    return f"with {', '.join(parts)}{more}"


def query(name: str, views: str, sql: str | None):
    """Registers a function from `Inputs` to a DataFrame; `sql` may use the named views."""

    def add(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _oracle(views, sql)
        return build

    return add
