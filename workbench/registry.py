"""Where the query modules register a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tvtrail.operators.hotkeys import HotKeys, find_hot_keys

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register the decorated function under its own name."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def hot_users(df: DataFrame, key: str = "user_id", ts: str = "ts") -> HotKeys:
    return find_hot_keys(df, key, ts)
