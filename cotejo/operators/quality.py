"""Catalogue checks: membership, appearing and disappearing members, ambiguous parents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.operators.aggregates import distinct_on, with_keys
from cotejo.operators.filters import in_months, month_bound
from cotejo.operators.joins import lookup_join

BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"


def _label(status: str, labels: Mapping[str, str]) -> Column:
    return F.lit(labels.get(status, status))


def membership_by_key(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    labels: Mapping[str, str] = {},
    status: str = "Status",
    order: Sequence[str] = (),
) -> DataFrame:
    """Which of two catalogues each key is in, one row per key.

    The other columns of both sides are kept, taken from the first row of the key by
    ``order``. One grouped aggregation over both sides: null keys match each other and a hot
    key is reduced before the shuffle.
    """
    keys = list(keys)

    def side(df: DataFrame, mark: str) -> tuple[DataFrame, list[str]]:
        extra = [c for c in df.columns if c not in keys]
        extra = [c for c in order if c in extra] + [c for c in extra if c not in order]
        attributes = F.struct(*extra) if extra else F.struct(F.lit(True).alias("present"))
        return df.select(*keys, attributes.alias(mark)), extra

    l, l_extra = side(left, "__left")
    r, r_extra = side(right, "__right")
    stacked = l.unionByName(r, allowMissingColumns=True)
    grouped = stacked.groupBy(*keys).agg(F.min("__left").alias("__left"), F.min("__right").alias("__right"))
    return grouped.select(
        *keys,
        *[F.col("__left")[c].alias(c) for c in left.columns if c in l_extra],
        *[F.col("__right")[c].alias(c) for c in right.columns if c in r_extra],
        F.when(F.col("__right").isNull(), _label(LEFT_ONLY, labels))
        .when(F.col("__left").isNull(), _label(RIGHT_ONLY, labels))
        .otherwise(_label(BOTH, labels))
        .alias(status),
    )


def membership_by_row(
    detailed: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    labels: Mapping[str, str] = {},
    status: str = "Status",
    detailed_is_left: bool = True,
    salts: int = 1,
) -> DataFrame:
    """Which of two catalogues each distinct row of the detailed side is in, by its key, and
    the keys that only the other side has.

    Both sides are reduced to distinct rows first. The detailed side keeps its rows through
    joins whose hot keys can be split (left and anti joins); a full outer join could not.
    Null keys match each other.
    """
    keys = list(keys)
    own_only, other_only = (LEFT_ONLY, RIGHT_ONLY) if detailed_is_left else (RIGHT_ONLY, LEFT_ONLY)
    rows = detailed.distinct()
    # Null keys meet each other through a marker beside a filled key.
    marks = [f"__null_{i}" for i in range(len(keys))]
    fills = [f"__key_{i}" for i in range(len(keys))]

    def matched(df: DataFrame) -> DataFrame:
        return df.withColumns({m: F.col(k).isNull() for m, k in zip(marks, keys)}).withColumns(
            {f: F.coalesce(F.col(k).cast("string"), F.lit("")) for f, k in zip(fills, keys)}
        )

    on = [*marks, *fills]
    other_keys = matched(other.select(*keys).distinct())
    flagged = lookup_join(
        matched(rows), other_keys.select(*on).withColumn("__hit", F.lit(True)), on, "left", salts
    )
    known = flagged.select(
        *detailed.columns,
        F.when(F.col("__hit"), _label(BOTH, labels)).otherwise(_label(own_only, labels)).alias(status),
    )
    missing = other_keys.join(matched(detailed.select(*keys).distinct()).select(*on), on, "left_anti")
    alone = missing.select(
        *[
            F.col(c) if c in keys else F.lit(None).cast(detailed.schema[c].dataType).alias(c)
            for c in detailed.columns
        ],
        _label(other_only, labels).alias(status),
    )
    return known.unionByName(alone)


def multi_parent_check(
    df: DataFrame,
    child: str,
    parent: str,
    status: str = "Status",
    ok: str = "Okay",
    warning: str = "Más de 1 molecula asociada",
    salts: int = 1,
) -> DataFrame:
    """Mark the rows whose child has more than one distinct parent; nulls are no parent.

    "More than one" is smallest <> largest, which needs no distinct count. Equal pairs are
    dropped first: that aggregates by hash, while the smallest of texts needs sorted rows. Only
    the ambiguous children are joined back.
    """
    ambiguous = (
        df.select(child, parent)
        .distinct()
        .groupBy(child)
        .agg(F.min(parent).alias("__low"), F.max(parent).alias("__high"))
        .filter(F.col("__low") != F.col("__high"))
        .select(child, F.lit(True).alias("__hit"))
    )
    rows = df.select(child, parent)
    return lookup_join(rows, ambiguous, [child], "left", salts).select(
        child,
        parent,
        F.when(F.col("__hit"), F.lit(warning)).otherwise(F.lit(ok)).alias(status),
    )


def period_membership(
    df: DataFrame,
    columns: Sequence[str],
    month: str = "Date",
    status: str = "Status",
    gone: str = "No Report",
    new: str = "New Report",
    current: Column | None = None,
    days: bool = False,
) -> DataFrame:
    """Members of the month before the newest one that the newest month lacks, and the
    reverse. "Newest" is the newest month of the whole table, not of a group.

    One aggregation over the two months instead of two distinct lists and two anti joins.
    With ``days`` the column holds dates inside the months; two bounds on it reach the scan.
    """
    if days:
        return _day_membership(df, columns, month, status, gone, new, current)
    newest = current if current is not None else df.agg(F.max(month)).scalar()
    previous = F.add_months(newest, -1)
    recent = with_keys(df, columns).filter(F.col(month).isin(newest, previous))
    seen = recent.groupBy(*columns).agg(
        F.bool_or(F.col(month) == newest).alias("__now"),
        F.bool_or(F.col(month) == previous).alias("__before"),
    )
    return seen.filter(F.col("__now") != F.col("__before")).select(
        *columns, F.when(F.col("__before"), F.lit(gone)).otherwise(F.lit(new)).alias(status)
    )


def _day_membership(df, columns, day, status, gone, new, current) -> DataFrame:
    newest = F.trunc(F.max(day) if current is None else F.max(current), "month")
    # One subquery: the planner would merge several into a struct, which the scan does not take.
    first = month_bound(df, day, df, F.add_months(newest, -1))
    border, after = (F.add_months(first, n).cast(df.schema[day].dataType) for n in (1, 2))
    recent = in_months(with_keys(df, columns), day, first, after)
    seen = recent.groupBy(*columns).agg(
        F.bool_or(F.col(day) >= border).alias("__now"), F.bool_or(F.col(day) < border).alias("__before")
    )
    return seen.filter(F.col("__now") != F.col("__before")).select(
        *columns, F.when(F.col("__before"), F.lit(gone)).otherwise(F.lit(new)).alias(status)
    )


def unresolved_keys(df: DataFrame, column: str, report: Sequence[str]) -> DataFrame:
    """Distinct report columns of the rows in which a looked-up column stayed null."""
    return df.filter(F.col(f"`{column}`").isNull()).select(*[F.col(f"`{c}`") for c in report]).distinct()


def first_unresolved(df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The same with one whole example row per key."""
    return distinct_on(df.filter(F.col(f"`{column}`").isNull()), keys, order)
