"""Registered queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and no build times, so that both engines print the same."""
    build_times = {"created_at", "updated_at", "checked_at", "load_date", "load_datetime"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`").alias(f.name)
            for f in df.schema
            if f.name not in build_times
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where one exists."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(function(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    from salesloom.registry import (  # noqa: F401
        adhoc,
        aggregates,
        checks,
        extensions,
        ingest,
        joins,
        profiles,
        projections,
        scalars,
        star,
        windows,
    )
