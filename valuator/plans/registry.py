"""Query registry: name -> (spark callable, oracle SQL).

Every registered query reads the driver tables of ``sf_dir`` (whole tables)
through the fixture views and runs one operator of the inventory. The oracle
SQL is written independently against the same views for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from valuator.sources.fixtures import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views) if views else sql.strip()
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from valuator.plans import (  # noqa: F401
        q_sources, q_scalar, q_encode, q_impute, q_profile, q_segment, q_cluster,
        q_train, q_ensemble, q_evaluate, q_joins,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
