"""Registry of named queries: a Spark builder and, where SQL can express
it, an independent DuckDB twin used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ids))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from kiln.plans import (power_plans, relational_plans, aggregate_plans,  # noqa: F401
                            window_plans, function_plans, source_plans, stats_plans,
                            stream_plans, ml_plans, fit_plans, keyed_plans)
    return REGISTRY
