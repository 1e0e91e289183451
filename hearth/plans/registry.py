"""Query registry: each registered query is a Spark callable ``(spark, sf_dir)
-> DataFrame`` and, where SQL can express it, the DuckDB text computing the
same rows with the same column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so their queries register themselves."""
    import importlib

    for mod in PLAN_MODULES:
        importlib.import_module(f"hearth.plans.{mod}")


PLAN_MODULES = ["cleaning", "profiling", "features_q", "evaluation", "linkage_q", "monitoring", "modeling",
                "sources_q", "checks_q", "registry_q"]
