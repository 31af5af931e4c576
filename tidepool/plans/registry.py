"""Query registry: name -> (Spark callable, DuckDB oracle text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
RAW: dict[str, str] = {}  # oracle texts as written, before the views they use are put in front


def query(name: str, oracle: str | None = None):
    """Register a query builder; ``oracle`` is DuckDB SQL over the driver tables and canonical views."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            RAW[name] = oracle
            ORACLE[name] = with_views(oracle)
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so its queries register."""
    from tidepool.plans import (catalog_analytics, catalog_layers, catalog_rows,  # noqa: F401
                                catalog_store, catalog_stream, catalog_text)
