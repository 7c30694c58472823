"""Registry of queries: one Spark plan and (where SQL can express it) one
DuckDB oracle statement per operator of the inventory.

Every query reads the driver's tables (through the derived raw layer), so
its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O
from .context import Warehouse

QueryFn = Callable[[Warehouse], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {n: (lambda spark, sf_dir, _f=f: _f(Warehouse(spark, sf_dir))) for n, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {n: s for n, (_, s) in REGISTRY.items() if s is not None}


def _load() -> None:
    # Importing the query modules fills REGISTRY.
    from . import queries_analytics, queries_core, queries_ops, queries_quality  # noqa: F401


__all__ = ["register", "queries", "oracle_sql", "O"]
