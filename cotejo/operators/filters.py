"""Row filters whose bound or member list comes from data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.text import _col


def optional_filters(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters for the arguments that are not None."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def differs(c: Column | str, value) -> Column:
    """Inequality that is true on null."""
    return ~_col(c).eqNullSafe(F.lit(value))


def _bound(df: DataFrame, column: str, expression: Column) -> Column:
    """One-row aggregate as scalar subquery, in the column's own type so that the comparison
    reaches the file scan."""
    data_type = df.schema[column].dataType
    return df.agg(expression.cast(data_type).alias("bound")).scalar()


def recent_years(df: DataFrame, column: str, back: int, as_of: date | None = None) -> DataFrame:
    """Rows whose year is at least the newest year minus ``back``.

    The condition is a lower bound on the raw date column. It is pushed to the scan, and with
    ``as_of`` it is a literal, which also prunes partitions when the plan is made.
    """
    if as_of is not None:
        bound = F.lit(date(as_of.year - back, 1, 1)).cast(df.schema[column].dataType)
    else:
        bound = _bound(df, column, F.make_date(F.year(F.max(column)) - back, F.lit(1), F.lit(1)))
    return df.filter(F.col(column) >= bound)


def in_months(df: DataFrame, raw: str, first: Column | None = None, after: Column | None = None) -> DataFrame:
    """Rows of the months from ``first`` on and before ``after``, by the raw date column that a
    month is derived from.

    ``month(raw) >= first`` is ``raw >= first`` when ``first`` begins a month, and the same for
    ``after``. The bounds are scalars of ``month_bound``, in the raw column's own type, so that
    they reach the scan; a comparison with the derived month does not.
    """
    if first is not None:
        df = df.filter(F.col(raw) >= first)
    return df if after is None else df.filter(F.col(raw) < after)


def month_bound(df: DataFrame, raw: str, source: DataFrame, expression: Column) -> Column:
    """One-row aggregate of ``source`` as scalar in the type of ``df[raw]``."""
    return source.agg(expression.cast(df.schema[raw].dataType).alias("bound")).scalar()


def months_of(df: DataFrame, raw: str) -> DataFrame:
    """Distinct months (their first days) of a date column, in the column ``month``."""
    return df.select(F.trunc(raw, "month").alias("month")).dropna().distinct()


def last_n_months(df: DataFrame, raw: str, n: int) -> DataFrame:
    """Rows of the ``n`` newest months that a date column has."""
    newest = months_of(df, raw).orderBy(F.desc("month")).limit(n)
    return in_months(df, raw, month_bound(df, raw, newest, F.min("month")))


def last_n_periods(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows of the ``n`` newest distinct values of ``column``."""
    newest = df.select(column).dropna().distinct().orderBy(F.desc(column)).limit(n)
    return df.filter(F.col(column) >= newest.agg(F.min(column)).scalar())


def before_first(df: DataFrame, other: DataFrame, column: str, raw: str | None = None) -> DataFrame:
    """Rows strictly before the first date of another table.

    ``raw`` names the date column that ``column`` is the month of, where ``df`` still has it:
    the bound is then put on the raw column, and the scan sees it.
    """
    if raw is None:
        return df.filter(F.col(column) < other.agg(F.min(column)).scalar())
    first = F.min(column)
    begins = F.trunc(first, "month")
    # Months before a day inside a month include that month.
    after = F.when(begins == first, begins).otherwise(F.add_months(begins, 1))
    return in_months(df, raw, after=month_bound(df, raw, other, after))


def exclude_month(df: DataFrame, column: str, year: int, month: int, where: Column | None = None) -> DataFrame:
    """Drop one month, optionally only for the rows where ``where`` holds (one input file)."""
    hit = (F.year(column) == year) & (F.month(column) == month)
    if where is not None:
        hit = hit & where
    return df.filter(~F.coalesce(hit, F.lit(False)))


def drop_totals(
    df: DataFrame,
    column: str,
    markers: Sequence[str] = ("Grand Total", "%all%"),
    null_is_total: bool = False,
) -> DataFrame:
    """Drop total rows. Tables have no row order here, so a total is known by its marker, not by
    being last. Rows without a key stay unless ``null_is_total``."""
    c = F.col(column)
    return df.filter(F.coalesce(~c.isin(*markers), F.lit(not null_is_total)))


def select_members(
    df: DataFrame,
    column: str,
    members: Sequence,
    selected: Sequence | None = None,
    remove: Sequence = (),
) -> DataFrame:
    """Keep the rows of chosen members of a column.

    Without ``selected`` the choice replaces any earlier one. With ``selected`` (the members
    chosen so far) it is a change: ``members`` are added, ``remove`` taken away. A request
    that names a member the column does not have gives an empty table.
    """
    asked = list(dict.fromkeys([*members, *remove]))
    if selected is None:
        keep = list(members)
    else:
        keep = [m for m in dict.fromkeys([*selected, *members]) if m not in set(remove)]
    if not asked:
        return df.filter(F.col(column).isin(keep)) if keep else df.filter(F.lit(False))
    known = df.filter(F.col(column).isin(asked)).agg(F.count_distinct(column)).scalar()
    return df.filter(F.col(column).isin(keep) & (known == len(asked)))


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of a total order (a report limited to ``n`` rows)."""
    return df.orderBy(*order).limit(n)


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns whose name contains the regular expression."""
    import re

    return [name for name in df.columns if re.search(pattern, name)]


def year_columns(df: DataFrame) -> list[str]:
    """Names made of digits only."""
    return [name for name in df.columns if name.isdigit()]
