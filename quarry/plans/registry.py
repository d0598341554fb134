"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = ("mart", "diner", "delivery", "subscriptions", "bank", "clicks", "storage")


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"quarry.plans.{m}")


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
