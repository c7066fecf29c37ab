"""Monthly series: holdout prediction, forecast and outlier flag.

A series is every combination of the series columns that occurs. All series are treated in
one plan; none is taken out and looped over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.functions.text import _col
from cotejo.functions.dates import month_range
from cotejo.operators.reshape import fill_months, gather_series


def series_of(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """The combinations that occur."""
    return df.select(*series).distinct()


def outlier(value: Column | str, prediction: Column | str, upper: float = 1.10, lower: float = 0.9) -> Column:
    """Prediction more than 10 % above or below the value; false when a side is missing."""
    v, p = _col(value), _col(prediction)
    return F.coalesce((p > F.lit(upper) * v) | (p < F.lit(lower) * v), F.lit(False))


# The arithmetic of the fit as SQL text: it is long, and text is planned in one call.
def _add_line(df: DataFrame, n: str, sum_y: str, sum_ty: str, name: str) -> DataFrame:
    """Add the least squares line over the positions 0 .. n-1 as ``name_slope``, ``name_level``.

    ``sum_y`` and ``sum_ty`` are the sums of the values and of position times value; the sums
    of the positions are closed forms, because months are dense. A single point has slope 0.
    """
    k, y, ty = f"{name}_n", f"{name}_y", f"{name}_ty"
    sum_t, sum_tt = f"({k} * ({k} - 1) / 2)", f"(({k} - 1) * {k} * (2 * {k} - 1) / 6)"
    return (
        df.selectExpr("*", f"double({n}) AS {k}", f"double({sum_y}) AS {y}", f"double({sum_ty}) AS {ty}")
        .selectExpr(
            "*",
            f"coalesce(try_divide({k} * {ty} - {sum_t} * {y}, {k} * {sum_tt} - {sum_t} * {sum_t}), 0D)"
            f" AS {name}_slope",
        )
        .selectExpr("*", f"try_divide({y} - {name}_slope * {sum_t}, {k}) AS {name}_level")
    )


def _add_guess(df: DataFrame, line: str, n: str, target: str, without: str, name: str) -> DataFrame:
    """Add the prediction for a position: the line, plus the mean distance from it of the
    fitted positions with the same calendar month. A calendar month that has not occurred
    adds nothing. ``without`` is what the fit leaves out of that month's sum."""
    first, c = f"pmod({target}, 12)", f"{name}_count"
    level, slope = f"{line}_level", f"{line}_slope"
    return df.selectExpr(
        "*",
        f"double(if({first} < {n}, floor(({n} - 1 - {first}) / 12) + 1, 0)) AS {c}",
        f"double(get(__calendar, month(add_months(__first, {target})) - 1) - {without}) AS {name}_sum",
    ).selectExpr(
        "*",
        f"{level} + {slope} * double({target}) + coalesce(try_divide({name}_sum - {level} * {c}"
        f" - {slope} * ({first} * {c} + 6 * {c} * ({c} - 1)), {c}), 0D) AS {name}",
    )


def forecast(
    df: DataFrame,
    series: Sequence[str],
    month: str = "Date",
    value: str = "Value",
    horizon: int = 3,
    prediction: str = "Prediction",
    flag: str = "isOutlier",
    until: Column | None = None,
) -> DataFrame:
    """History of every series with a prediction for its last month, and ``horizon`` months
    more.

    Each series is extended with zeros to the last month of the table. A line and the means
    of the calendar months are fitted on all months but the last to predict the last one
    (rounded up), and on all months to predict the following ones. A series of one month has
    no prediction for it.

    Everything the fit needs is a sum over the months that have rows, zeros add nothing. So
    the models of all series are one grouped aggregation, in exact decimals of two digits,
    and predictions are arithmetic on its result.
    """
    bound = until if until is not None else df.agg(F.max(month)).scalar()
    y, index = f"`{value}`", f"(year(`{month}`) * 12 + month(`{month}`))"
    by_calendar = ", ".join(
        f"coalesce(sum({y}) FILTER (WHERE month(`{month}`) = {m}), 0)" for m in range(1, 13)
    )
    s = gather_series(
        df, series, month, value, bound, "decimal(18,2)",
        __sum=F.expr(f"sum({y})"),
        __sum_at=F.expr(f"sum({y} * {index})"),
        __last=F.coalesce(F.sum(F.when(F.col(month) == bound, F.col(value))), F.lit(0)),
        __calendar=F.expr(f"array({by_calendar})"),
    )
    origin = "(year(__first) * 12 + month(__first))"
    s = s.selectExpr(
        "*",
        f"year(__until) * 12 + month(__until) - {origin} + 1 AS __n",
        f"__sum_at - {origin} * __sum AS __sum_t",
    )
    # Steps as columns: an expression that is used twice is then computed once.
    s = _add_line(s, "__n - 1", "__sum - __last", "__sum_t - (__n - 1) * __last", "__train")
    s = _add_line(s, "__n", "__sum", "__sum_t", "__whole")
    s = _add_guess(s, "__train", "(__n - 1)", "(__n - 1)", "__last", "__next")
    for k in range(horizon):
        s = _add_guess(s, "__whole", "__n", f"(__n + {k})", "0", f"__ahead_{k}")
    row = (
        f"named_struct('{month}', {{}}, '{value}', cast({{}} AS decimal(38, 2)), "
        f"'{prediction}', cast({{}} AS double))"
    )
    ahead = ", ".join(
        row.format(f"add_months(__until, {k + 1})", "null", f"__ahead_{k}") for k in range(horizon)
    )
    filled = fill_months(F.col("__by_month"), month_range("__first", "__until"))
    s = s.withColumn("__filled", F.map_entries(filled))
    history = f"transform(__filled, e -> {row.format('e.key', 'e.value', 'null')})"
    rows = s.selectExpr(
        *[f"`{c}`" for c in series],
        "__until",
        "ceil(__next) AS __holdout",
        f"inline(concat({history}, array({ahead})))",
    )
    return rows.selectExpr(
        *[f"`{c}`" for c in series],
        f"`{month}`",
        f"double(`{value}`) AS `{value}`",
        f"if(`{month}` = __until, double(__holdout), `{prediction}`) AS `{prediction}`",
    ).withColumn(flag, outlier(value, prediction))


def forecast_with(
    df: DataFrame,
    series: Sequence[str],
    fit_predict: Callable[[pd.DataFrame, pd.DataFrame], pd.Series],
    month: str = "Date",
    value: str = "Value",
    horizon: int = 3,
    prediction: str = "Prediction",
    flag: str = "isOutlier",
    until: Column | None = None,
) -> DataFrame:
    """The same with a model of the caller, for libraries found on the workers.

    ``fit_predict(train, target)`` gets frames with ``year``, ``quarter``, ``month`` (and
    ``value`` in ``train``) and returns predictions for ``target``. Each call sees one
    series, which has one row per calendar month.
    """
    gathered = gather_series(df, series, month, value, until, exact="decimal(18,2)")
    shape = df.select(*series).schema
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in shape.fields],
            T.StructField(month, T.DateType()),
            T.StructField(value, T.DoubleType()),
            T.StructField(prediction, T.DoubleType()),
        ]
    )
    keys = list(series)

    def features(first, count: int) -> pd.DataFrame:
        index = pd.date_range(first, periods=count, freq="MS")
        return pd.DataFrame(
            {"date": index, "year": index.year, "quarter": index.quarter, "month": index.month}
        )

    def per_batch(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                record = dict(zip(batch.columns, row))
                values = list(record["__values"])
                n = len(values)
                frame = features(record["__first"], n + horizon)
                frame["value"] = values + [float("nan")] * horizon
                inputs = ["year", "quarter", "month"]
                guess = [float("nan")] * n
                if n > 1:
                    last = fit_predict(frame.iloc[: n - 1], frame.iloc[n - 1 : n][inputs])
                    guess[n - 1] = float(-(-float(list(last)[0]) // 1))
                guess += [float(x) for x in fit_predict(frame.iloc[:n], frame.iloc[n:][inputs])]
                out = pd.DataFrame({k: [record[k]] * len(frame) for k in keys})
                out[month] = frame["date"].dt.date
                out[value] = frame["value"]
                out[prediction] = guess
                yield out

    filled = F.map_entries(fill_months(F.col("__by_month"), month_range("__first", "__until")))
    ordered = F.transform(F.array_sort(filled), lambda e: e["value"].cast("double"))
    plain = gathered.select(*keys, "__first", ordered.alias("__values"))
    predicted = plain.mapInPandas(per_batch, schema)
    missing = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return predicted.select(*keys, month, missing(value), missing(prediction)).withColumn(
        flag, outlier(value, prediction)
    )
