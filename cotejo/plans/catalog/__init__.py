"""Queries over the star-schema test tables, one or more per operator, each with the
statement DuckDB runs to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    from cotejo.plans.catalog import (  # noqa: F401
        basics,
        comparisons,
        payloads,
        public_health,
        snapshots,
        text,
        time_series,
    )
