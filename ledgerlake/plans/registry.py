"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (through the fixture views). Oracle SQL is None only for operators
that cannot be written as one SQL statement (streams, writes, model fitting);
those get a rows-only check from the driver and a pytest check here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .context import Ctx


@dataclass
class Query:
    name: str
    build: Callable[[Ctx], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Ctx], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills REGISTRY
    from . import (q_fraud, q_functions, q_incremental, q_io, q_lifecycle, q_medallion, q_pci,  # noqa: F401
                   q_settlement, q_streaming)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(q: Query):
        return lambda spark, sf_dir: q.build(Ctx(spark, sf_dir))

    return {name: bind(q) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
