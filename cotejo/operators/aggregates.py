"""Grouped sums, distinct rows and shares of them.

Every operator here aggregates before the shuffle, so a key that holds a large part of the
rows reaches its task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which no key is null; plain null tests are pushed to the scan."""
    for key in keys:
        df = df.filter(F.col(f"`{key}`").isNotNull())
    return df


def group_sum(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] | Mapping[str, str],
    exact: str | None = None,
    keep_nulls: bool = False,
) -> DataFrame:
    """Sum measures per key; a group of nulls sums to 0. Rows with a null key are dropped, or
    with ``keep_nulls`` a null is a key like others.

    ``exact`` names a decimal type to sum in, which makes the result independent of the order
    in which tasks finish. ``measures`` may rename: ``{"new": "old"}``.
    """
    named = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    sums = [
        F.coalesce(F.sum(F.col(old).cast(exact) if exact else F.col(old)), F.lit(0)).alias(new)
        for new, old in named.items()
    ]
    return (df if keep_nulls else with_keys(df, keys)).groupBy(*keys).agg(*sums)


def distinct_on(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """One row per key: the first (or last) by ``order``, nulls lowest, ties broken by the
    remaining columns.

    Written as ``min``/``max`` of a struct: only one candidate per key and task is shuffled.
    A ``row_number`` window would bring every row of a hot key to one task and sort it there.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ordered = [c for c in order if c not in keys]
    ordered += [c for c in rest if c not in ordered]
    pick = F.min if keep == "first" else F.max
    best = df.groupBy(*keys).agg(pick(F.struct(*ordered)).alias("__best"))
    return best.select(*[c if c in keys else F.col("__best")[c].alias(c) for c in df.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def conditional_sum(condition: Column, value: Column | str) -> Column:
    """Sum over the rows where the condition holds: null when there is no such row, 0 when
    all their values are null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, F.coalesce(value, F.lit(0))))
