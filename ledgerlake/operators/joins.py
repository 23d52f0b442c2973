"""Joins of the pipelines: dimension lookups, calendar join, membership and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def join_calendar_fact(calendar: DataFrame, fact: DataFrame, key: str = "date_key") -> DataFrame:
    """calendar LEFT JOIN fact, keeping days without facts.

    The calendar is bounded (days + 1 rows) and is broadcast into an inner join with
    the fact, so the fact is never shuffled; days without any fact are added back by an
    anti join against the fact's distinct keys (a map-side-combined, day-sized set).
    """
    matched = fact.join(F.broadcast(calendar), on=key, how="inner")
    fact_days = fact.select(key).distinct()
    empty = calendar.join(fact_days, on=key, how="left_anti")
    return matched.unionByName(empty, allowMissingColumns=True)


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """fact LEFT JOIN dim ON key. The dimension is one row per key; AQE turns the join
    into a broadcast when the dimension's runtime size is under the threshold and keeps
    a sort-merge join (with skew splitting) beyond it."""
    return fact.join(dim.select(key, *columns), on=key, how="left")


def anti_existing(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``target`` (NOT EXISTS; decision D-06:
    a NULL key in the target does not empty the result as ``NOT IN`` would)."""
    return source.join(target.select(key).distinct(), on=key, how="left_anti")


def semi_allowed(df: DataFrame, allowed: DataFrame, key: str, allowed_key: str | None = None) -> DataFrame:
    """Rows whose ``key`` is in the allowed set (``IN (SELECT ...)``) as a left semi join."""
    allowed_key = allowed_key or key
    a = allowed.select(F.col(allowed_key).alias(key))
    return df.join(a, on=key, how="left_semi")
