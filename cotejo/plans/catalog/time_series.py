"""Dense monthly series, forecast and outlier flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.dates import month_start
from cotejo.functions.numbers import MONEY
from cotejo.operators import reshape, series
from cotejo.operators.aggregates import group_sum
from cotejo.plans.catalog import query, table
from cotejo.sources.payload_text import text_to_rows

SERIES = ["supplier", "flag"]

# Monthly quantity per supplier and return flag; a series has gaps, and may end early.
_DENSE = """
    m AS (SELECT l_suppkey AS supplier, l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS d,
                 sum(CAST(l_quantity AS DECIMAL(18,2))) AS v
          FROM lineitem GROUP BY 1, 2, 3),
    b AS (SELECT supplier, flag, min(d) AS first, (SELECT max(d) FROM m) AS last FROM m GROUP BY 1, 2),
    c AS (SELECT supplier, flag, first,
                 CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS d FROM b),
    dense AS (SELECT c.supplier, c.flag, c.first, c.d, coalesce(m.v, 0) AS v,
                     date_diff('month', c.first, c.d) AS t
              FROM c LEFT JOIN m ON m.supplier = c.supplier AND m.flag = c.flag AND m.d = c.d)
"""


def _monthly(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"),
        F.col("l_returnflag").alias("flag"),
        month_start("l_shipdate").alias("Date"),
        F.col("l_quantity").alias("Value"),
    )


@query(
    "densify_months",
    f"""
    WITH {_DENSE} SELECT supplier, flag, d AS "Date", CAST(v AS DOUBLE) AS "Value" FROM dense
    """,
)
def densify_months(spark, folder):
    dense = reshape.densify_months(_monthly(spark, folder), SERIES, "Date", "Value", exact=MONEY)
    return dense.withColumn("Value", F.col("Value").cast("double"))


@query(
    "densify_days",
    """
    WITH m AS (SELECT o_orderpriority AS priority, CAST(date_trunc('month', o_orderdate) AS DATE) AS d,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders
               WHERE o_orderpriority <> '5-LOW' OR day(o_orderdate) > 27 GROUP BY 1, 2),
    c AS (SELECT priority, CAST(unnest(generate_series(min(d), (SELECT max(d) FROM m), INTERVAL 1 MONTH)) AS DATE) AS d
          FROM m GROUP BY 1)
    SELECT c.priority, c.d AS "Date", CAST(coalesce(m.v, 0) AS DOUBLE) AS "Value"
    FROM c LEFT JOIN m ON m.priority = c.priority AND m.d = c.d
    """,
)
def densify_days(spark, folder):
    """Days inside the months, some of which a series lacks."""
    day = F.to_date("o_orderdate")
    rows = table(spark, folder, "orders").filter((F.col("o_orderpriority") != "5-LOW") | (F.dayofmonth(day) > 27))
    rows = rows.select(F.col("o_orderpriority").alias("priority"), day.alias("Date"), F.col("o_totalprice").alias("Value"))
    dense = reshape.densify_months(rows, ["priority"], "Date", "Value", exact=MONEY)
    return dense.withColumn("Value", F.col("Value").cast("double"))


@query("series_split", "SELECT DISTINCT l_suppkey AS supplier, l_returnflag AS flag FROM lineitem")
def series_split(spark, folder):
    return series.series_of(_monthly(spark, folder), SERIES)


def _fit_sql(name: str, length: str) -> str:
    """Line over the first ``length`` months of each series, ``n`` being its whole length."""
    return f"""
    {name}_sums AS (
        SELECT supplier, flag, CAST(count(*) AS DOUBLE) AS k,
               CAST(sum(v) AS DOUBLE) AS sy, CAST(sum(v * t) AS DOUBLE) AS sty
        FROM dense JOIN size USING (supplier, flag) WHERE t < {length} GROUP BY 1, 2),
    {name} AS (
        SELECT supplier, flag, slope, (sy - slope * st) / k AS level
        FROM (SELECT *, k * (k - 1) / 2 AS st,
                     coalesce((k * sty - (k * (k - 1) / 2) * sy)
                              / nullif(k * ((k - 1) * k * (2 * k - 1) / 6) - (k * (k - 1) / 2) * (k * (k - 1) / 2), 0), 0) AS slope
              FROM {name}_sums))
    """


def _guess_sql(fit: str, length: str, target: str) -> str:
    """Prediction for position ``target``: the line and the mean of its calendar month."""
    return f"""
        SELECT s.supplier, s.flag, s.first, {target} AS t,
               f.level + f.slope * CAST({target} AS DOUBLE)
               + coalesce((CAST(sum(d.v) AS DOUBLE) - f.level * CAST(count(d.v) AS DOUBLE) - f.slope * CAST(sum(d.t) AS DOUBLE))
                          / nullif(CAST(count(d.v) AS DOUBLE), 0), 0) AS p
        FROM size s JOIN {fit} f ON s.supplier = f.supplier AND s.flag = f.flag
        LEFT JOIN dense d ON d.supplier = s.supplier AND d.flag = s.flag
                          AND d.t < {length} AND (({target} - d.t) % 12) = 0
        GROUP BY s.supplier, s.flag, s.first, s.n, f.level, f.slope
    """


@query(
    "forecast_outliers",
    f"""
    WITH {_DENSE},
    size AS (SELECT supplier, flag, min(first) AS first, count(*) AS n FROM dense GROUP BY 1, 2),
    {_fit_sql("train", "n - 1")},
    {_fit_sql("whole", "n")},
    holdout AS ({_guess_sql("train", "s.n - 1", "s.n - 1")}),
    future AS ({" UNION ALL ".join(_guess_sql("whole", "s.n", f"s.n + {k}") for k in range(3))}),
    r AS (
        SELECT d.supplier, d.flag, d.d AS "Date", CAST(d.v AS DOUBLE) AS "Value", ceil(h.p) AS "Prediction"
        FROM dense d LEFT JOIN holdout h ON h.supplier = d.supplier AND h.flag = d.flag AND h.t = d.t
        UNION ALL
        SELECT supplier, flag, CAST(first + to_months(CAST(t AS INTEGER)) AS DATE), NULL, p FROM future)
    SELECT supplier, flag, "Date", "Value", round_even("Prediction", 6) AS "Prediction",
           coalesce("Prediction" > 1.10 * "Value" OR "Prediction" < 0.9 * "Value", false) AS "isOutlier"
    FROM r
    """,
)
def forecast_outliers(spark, folder):
    predicted = series.forecast(_monthly(spark, folder), SERIES)
    return predicted.withColumn("Prediction", F.bround("Prediction", 6))


@query(
    "outlier_rule",
    f"""
    WITH {_DENSE},
    p AS (SELECT a.supplier, a.flag, a.d, CAST(a.v AS DOUBLE) AS v, CAST(b.v AS DOUBLE) AS p
          FROM dense a FULL JOIN dense b
            ON a.supplier = b.supplier AND a.flag = b.flag AND a.d = CAST(b.d + INTERVAL 12 MONTH AS DATE)
          WHERE a.d IS NOT NULL)
    SELECT supplier, flag, d AS "Date", v AS "Value", p AS "Prediction",
           coalesce(p > 1.10 * v OR p < 0.9 * v, false) AS "isOutlier"
    FROM p
    """,
)
def outlier_rule(spark, folder):
    """The value of the year before as prediction. Each month gives one row for itself and one
    for the month a year later, and these are summed: no join of the series with itself."""
    dense = reshape.densify_months(_monthly(spark, folder), SERIES, "Date", "Value", exact=MONEY)
    own = "named_struct('Date', Date, 'Value', double(Value), 'Prediction', double(null))"
    later = "named_struct('Date', add_months(Date, 12), 'Value', double(null), 'Prediction', double(Value))"
    both = (
        dense.selectExpr(*SERIES, f"inline(array({own}, {later}))")
        .groupBy(*SERIES, "Date")
        .agg(F.max("Value").alias("Value"), F.max("Prediction").alias("Prediction"))
    )
    return both.filter(F.col("Value").isNotNull()).withColumn("isOutlier", series.outlier("Value", "Prediction"))


@query(
    "crosstab_melt",
    """
    WITH y AS (SELECT CAST(unnest(range(a, b + 1)) AS INTEGER) AS year
               FROM (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem)), m AS (SELECT unnest(range(1, 13)) AS month),
    s AS (SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS mxn
          FROM lineitem GROUP BY 1, 2, 3),
    g AS (SELECT supplier, year, month FROM (SELECT DISTINCT supplier FROM s), y, m),
    w AS (SELECT g.supplier, make_date(g.year, g.month, 1) AS d, units, mxn
          FROM g LEFT JOIN s ON g.supplier = s.supplier AND g.year = s.year AND g.month = s.month)
    SELECT supplier, d AS "Date", 'Units' AS "Metric", units AS "Value" FROM w
    UNION ALL SELECT supplier, d, 'MXN', mxn FROM w
    """,
)
def crosstab_melt(spark, folder):
    """A year x month sheet per supplier, as tab separated text, back to a long fact."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("month"),
        "l_quantity",
        "l_extendedprice",
    )
    first, last = lines.agg(F.min("month"), F.max("month")).first()
    years_of = range(first // 100, last // 100 + 1)
    sums = group_sum(lines, ["supplier", "month"], {"q": "l_quantity", "p": "l_extendedprice"}, MONEY)
    # At most one entry per month of the years; a cell without an entry is blank.
    cells = F.concat_ws("\t", F.col("q").cast("string"), F.col("p").cast("string"))
    gathered = sums.groupBy("supplier").agg(
        F.map_from_entries(F.collect_list(F.struct("month", cells.alias("cells")))).alias("cells")
    )
    by_month = [
        F.concat_ws(
            "\t",
            F.lit(str(m)),
            *[F.coalesce(F.try_element_at("cells", F.lit(y * 100 + m)), F.lit("\t")) for y in years_of],
        )
        for m in range(1, 13)
    ]
    years = "\t".join(["Mes"] + [f"{y}\t" for y in years_of])
    names = "\t".join([""] + ["PIEZAS\tIMPORTE" for _ in years_of])
    sheets = gathered.select("supplier", F.concat_ws("\n", F.lit(f"{years}\n{names}\n"), *by_month).alias("sheet"))
    rows = text_to_rows(sheets, ["supplier"], "sheet", "rows")
    return reshape.crosstab_to_long(
        rows, ["supplier"], "rows", {"Units": "PIEZAS", "MXN": "IMPORTE"}, drop_columns=1
    )
