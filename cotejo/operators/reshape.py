"""Between wide and long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.arrays import spread
from cotejo.functions.dates import month_from_parts, month_range
from cotejo.operators.aggregates import conditional_sum, group_sum, with_keys


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    variable: str = "Metric",
    value: str = "Value",
) -> DataFrame:
    """Measures to rows; null measures are kept."""
    return df.unpivot(list(ids), list(values), variable, value)


def melt_sum(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    variable: str = "Metric",
    value: str = "Value",
    exact: str | None = None,
    keep_nulls: bool = False,
) -> DataFrame:
    """Long fact with one row per key and measure.

    Sums first and melts the sums: melting first would double the rows that are aggregated.
    """
    return melt(group_sum(df, keys, measures, exact, keep_nulls), keys, measures, variable, value)


def pivot_sum_max(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    names: Mapping[str, str],
    total: str = "TOTAL",
    newest: str = "MAX_DATE",
    total_prefix: str = "TOTAL_",
    newest_prefix: str = "DATE_",
    rest: str | None = None,
) -> DataFrame:
    """Long to wide by the values of ``column``, sum of one column and maximum of another.

    ``names`` maps each value of ``column`` to the suffix of its output columns. With the
    values known this is one conditional aggregation: no job to find the values, one shuffle.
    Rows of other values, null among them, are left out, or with ``rest`` gathered under that
    suffix.
    """
    dates = [
        F.max(F.when(F.col(column) == v, F.col(newest))).alias(newest_prefix + name)
        for v, name in names.items()
    ]
    totals = [
        conditional_sum(F.col(column) == v, total).alias(total_prefix + name)
        for v, name in names.items()
    ]
    kept = with_keys(df, index)
    if rest is None:
        kept = kept.filter(F.col(column).isin(*names))
    else:
        other = ~F.coalesce(F.col(column).isin(*names), F.lit(False))
        dates.append(F.max(F.when(other, F.col(newest))).alias(newest_prefix + rest))
        totals.append(conditional_sum(other, total).alias(total_prefix + rest))
    return kept.groupBy(*index).agg(*dates, *totals)


def crosstab_to_long(
    df: DataFrame,
    ids: Sequence[str],
    rows: str,
    measures: Mapping[str, str],
    drop_columns: int = 0,
    first_data_row: int = 3,
) -> DataFrame:
    """Year x measure crosstab to (ids, Date, Metric, Value).

    ``rows`` holds a whole sheet as array of rows of cell texts: years in the first row,
    repeated measure names in the second, one row per month from ``first_data_row`` on. A sheet
    with text below its twelfth month is an error: no row is cut off.
    The k-th column whose name contains a measure's pattern belongs to the k-th year.
    A sheet is one row of the table, so the work is local to it and nothing is shuffled.
    """
    sheet = F.col(rows)
    width = F.greatest(F.size(sheet[1]) - drop_columns, F.lit(0))
    by_month = df.select(
        *ids,
        F.filter(sheet[0], lambda cell: F.trim(cell).rlike("^[0-9]+$")).alias("__years"),
        F.slice(sheet[1], drop_columns + 1, width).alias("__names"),
        F.posexplode(F.slice(sheet, first_data_row + 1, F.greatest(F.size(sheet) - first_data_row, F.lit(0)))).alias("__month", "__cells"),
    )
    blank = F.forall("__cells", lambda cell: F.coalesce(F.trim(cell) == "", F.lit(True)))
    beyond = F.raise_error(F.concat(F.lit("sheet row below the twelfth month: "), F.concat_ws("|", "__cells")))
    by_month = by_month.filter(F.when(F.col("__month") < 12, True).when(blank, False).otherwise(beyond.cast("boolean")))

    def of_measure(metric: str, pattern: str) -> Column:
        positions = F.filter(
            F.transform("__names", lambda name, i: F.when(name.rlike(pattern), i)), lambda i: i.isNotNull()
        )
        return F.transform(
            positions,
            lambda position, k: F.struct(
                F.get("__years", k).alias("year"),
                F.lit(metric).alias("Metric"),
                F.get("__cells", position + drop_columns).alias("text"),
            ),
        )

    cells = F.concat(*[of_measure(metric, pattern) for metric, pattern in measures.items()])
    return (
        by_month.select(*ids, "__month", F.inline(cells))
        .select(
            *ids,
            month_from_parts("year", F.col("__month") + 1).alias("Date"),
            "Metric",
            F.regexp_replace("text", "[$,]", "").try_cast("double").alias("Value"),
        )
        .filter(F.col("Date").isNotNull())
    )


def densify_months(
    df: DataFrame,
    series: Sequence[str],
    month: str,
    value: str,
    until: Column | None = None,
    exact: str | None = None,
) -> DataFrame:
    """One row per series and month from the first month of the series to ``until`` (the last
    month of the whole table by default), 0 where the series has no rows.

    The monthly sums of a series are at most one row per calendar month; they are gathered
    into one row per series and filled there, without a join to a calendar.
    """
    gathered = gather_series(df, series, month, value, until, exact)
    filled = fill_months(F.col("__by_month"), month_range("__first", "__until"))
    return spread(gathered, series, filled, month, value)


def gather_series(
    df: DataFrame,
    series: Sequence[str],
    month: str,
    value: str,
    until: Column | None = None,
    exact: str | None = None,
    **sums: Column,
) -> DataFrame:
    """One row per series: the map ``__by_month`` of its monthly sums, its ``__first`` month,
    the last month ``__until`` of the whole table, and further aggregates over the sums. Dates
    inside a month count for its first day."""
    until = df.agg(F.trunc(F.max(month), "month")).scalar() if until is None else F.trunc(until, "month")
    df = df.withColumn(month, F.trunc(month, "month"))
    monthly = group_sum(df, [*series, month], [value], exact)
    gathered = monthly.groupBy(*series).agg(
        F.map_from_entries(F.collect_list(F.struct(month, value))).alias("__by_month"),
        F.min(month).alias("__first"),
        *[column.alias(name) for name, column in sums.items()],
    )
    return gathered.withColumn("__until", until)


def fill_months(by_month: Column, months: Column) -> Column:
    """The map with an entry for every one of ``months``, 0 where there was none."""
    zeros = F.map_from_arrays(months, F.array_repeat(F.lit(0), F.size(months)))
    return F.map_zip_with(by_month, zeros, lambda _, v, zero: F.coalesce(v, zero))
