"""Queries by name: a function of a table getter, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orbitgrain.plans.views import VIEWS, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def q(name: str, sql: str | None = None):
    """Register ``f(v)``, ``v(name)`` being a view or a given table."""

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: view(spark, sf_dir, t) if t in VIEWS else spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql)
        return f

    return register


def at(expression: str) -> str:
    """A time as text in SQL."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def load() -> tuple[dict, dict]:
    """All queries and their SQL."""
    from orbitgrain.plans import catalog_queries, pixel_queries, storage_queries  # noqa: F401

    return QUERIES, ORACLES
