"""Rows out of arrays and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(
    df: DataFrame, kept: Sequence[str | Column], values: Column | str, *names: str, position: str | None = None
) -> DataFrame:
    """One row per element of an array (one name) or entry of a map (two), with its position if
    that has a name. Empty and null ones give no rows.

    The plain generators bring a filter "not empty" that the optimizer moves below the steps
    which make the array, where it computes them a second time; an outer one, whose empty rows
    are dropped after it, does not.
    """
    place = position or "__position"
    rows = df.select(*kept, F.posexplode_outer(values).alias(place, *names)).filter(F.col(place).isNotNull())
    return rows if position else rows.drop(place)


def spread_structs(df: DataFrame, kept: Sequence[str | Column], values: Column | str) -> DataFrame:
    """One row per struct of an array, its fields as columns."""
    rows = spread(df, kept, values, "__struct")
    return rows.select(*[c for c in rows.columns if c != "__struct"], "__struct.*")
