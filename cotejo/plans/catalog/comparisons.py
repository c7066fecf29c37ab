"""Reconciliation, membership and period checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.dates import month_start
from cotejo.functions.numbers import MONEY
from cotejo.operators import quality, reconcile
from cotejo.operators.aggregates import group_sum
from cotejo.plans.catalog import query, table

KEYS = ["Date", "Status", "Metric"]

# Orders (x) against line items (y) by month and status. Status P exists only in orders, and
# shipping goes on for some months after the last order.
_SIDES = """
    x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date", o_orderstatus AS "Status",
                 'USD' AS "Metric", sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
          FROM orders GROUP BY 1, 2),
    y AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", l_linestatus AS "Status",
                 'USD' AS "Metric", sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
          FROM lineitem GROUP BY 1, 2),
    j AS (SELECT coalesce(x."Date", y."Date") AS "Date", coalesce(x."Status", y."Status") AS "Status",
                 'USD' AS "Metric", x.v AS xv, y.v AS yv,
                 CAST(x.v AS DOUBLE) AS xd, CAST(y.v AS DOUBLE) AS yd
          FROM x FULL JOIN y ON x."Date" = y."Date" AND x."Status" = y."Status")
"""


def difference_sql(mode: str) -> str:
    """Difference columns over ``xv, yv`` (decimal) and ``xd, yd`` (double)."""
    inner = "xv - yv" if mode == "signed" else "abs(xv - yv)"
    base, other = ("yd", "xd") if mode == "rounded" else ("xd", "yd")
    return f"""
        xd AS "Value_x", yd AS "Value_y",
        CAST(CASE WHEN xv IS NOT NULL AND yv IS NOT NULL THEN {inner} ELSE greatest(xv, yv) END AS DOUBLE)
            AS "Diff Abs",
        CASE WHEN {base} = 0 THEN -1.0 WHEN xd IS NOT NULL AND yd IS NOT NULL THEN {other} / {base} - 1
             ELSE -1.0 END AS "Diff %",
        CASE WHEN xv IS NULL OR yv IS NULL THEN 'Un origen no tiene información'
             WHEN xv = yv THEN 'Sin diferencias' ELSE 'Sin identificar' END AS "Motivo"
    """


def to_double(df):
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in ("Value_x", "Value_y", "Diff Abs")})


def _sides(spark, folder):
    orders = table(spark, folder, "orders").select(
        month_start("o_orderdate").alias("Date"),
        F.col("o_orderstatus").alias("Status"),
        F.lit("USD").alias("Metric"),
        F.col("o_totalprice").cast(MONEY).alias("Value"),
    )
    lines = table(spark, folder, "lineitem").select(
        month_start("l_shipdate").alias("Date"),
        F.col("l_linestatus").alias("Status"),
        F.lit("USD").alias("Metric"),
        F.col("l_extendedprice").cast(MONEY).alias("Value"),
    )
    return orders, lines


def _reconcile(mode):
    def run(spark, folder):
        left, right = _sides(spark, folder)
        return to_double(reconcile.reconcile(left, right, KEYS, mode))

    return run


for _mode in ("abs", "signed", "rounded"):
    query(
        f"reconcile_{_mode}",
        f'WITH {_SIDES} SELECT "Date", "Status", "Metric", {difference_sql(_mode)} FROM j',
    )(_reconcile(_mode))


@query(
    "reconcile_missing_dims",
    f"""
    WITH x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date",
                      CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS "Status",
                      CASE WHEN o_orderpriority <> '5-LOW' THEN 'USD' END AS "Metric",
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2, 3),
    y AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
                 CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS "Status",
                 CASE WHEN l_linenumber > 1 THEN 'USD' END AS "Metric",
                 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1, 2, 3),
    j AS (SELECT coalesce(x."Date", y."Date") AS "Date", coalesce(x."Status", y."Status") AS "Status",
                 coalesce(x."Metric", y."Metric") AS "Metric", x.v AS xv, y.v AS yv,
                 CAST(x.v AS DOUBLE) AS xd, CAST(y.v AS DOUBLE) AS yd
          FROM x FULL JOIN y ON x."Date" = y."Date" AND x."Status" IS NOT DISTINCT FROM y."Status"
               AND x."Metric" IS NOT DISTINCT FROM y."Metric")
    SELECT "Date", "Status", "Metric", {difference_sql("abs")} FROM j
    """,
)
def reconcile_missing_dims(spark, folder):
    """Two facts in which dimensions are missing: rows without one are a group like others, and
    those of the two sides meet."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    left = orders.select(
        month_start("o_orderdate").alias("Date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("Status"),
        F.when(F.col("o_orderpriority") != "5-LOW", "USD").alias("Metric"),
        F.col("o_totalprice").alias("Value"),
    )
    right = lines.select(
        month_start("l_shipdate").alias("Date"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("Status"),
        F.when(F.col("l_linenumber") > 1, "USD").alias("Metric"),
        F.col("l_extendedprice").alias("Value"),
    )
    sums = [group_sum(side, KEYS, ["Value"], MONEY, keep_nulls=True) for side in (left, right)]
    return to_double(reconcile.reconcile(*sums, KEYS))


_CHAIN_SOURCES = """
    l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", l_returnflag AS "Flag",
                 CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                 CAST(l_discount AS DECIMAL(5,2)) AS discount, CAST(l_tax AS DECIMAL(5,2)) AS tax
          FROM lineitem),
    gross AS (SELECT "Date", "Flag", sum(price) AS v FROM l GROUP BY 1, 2),
    kept AS (SELECT "Date", "Flag", sum(price) AS v FROM l WHERE "Flag" <> 'R' GROUP BY 1, 2),
    net AS (SELECT "Date", "Flag", sum(price * (1 - discount)) AS v FROM l GROUP BY 1, 2),
    taxed AS (SELECT "Date", "Flag", sum(price * (1 + tax)) AS v FROM l
              WHERE "Date" < DATE '2001-01-01' GROUP BY 1, 2)
"""


def _pair_sql(label, a, b):
    return f"""
        SELECT '{label}' AS "Comparativa", coalesce(a."Date", b."Date") AS "Date",
               coalesce(a."Flag", b."Flag") AS "Flag",
               round_even(a.v, 2) AS xv, round_even(b.v, 2) AS yv,
               CAST(round_even(a.v, 2) AS DOUBLE) AS xd, CAST(round_even(b.v, 2) AS DOUBLE) AS yd
        FROM {a} a FULL JOIN {b} b ON a."Date" = b."Date" AND a."Flag" = b."Flag"
    """


@query(
    "reconcile_chain",
    f"""
    WITH {_CHAIN_SOURCES},
    j AS ({_pair_sql("Gross vs Kept", "gross", "kept")}
          UNION ALL {_pair_sql("Kept vs Net", "kept", "net")}
          UNION ALL {_pair_sql("Net vs Taxed", "net", "taxed")})
    SELECT "Comparativa", "Date", "Flag", {difference_sql("rounded")} FROM j
    """,
)
def reconcile_chain(spark, folder):
    """Four sources compared pairwise with one shuffle."""
    price = F.col("l_extendedprice").cast(MONEY)
    discount, tax = F.col("l_discount").cast("decimal(5,2)"), F.col("l_tax").cast("decimal(5,2)")
    lines = table(spark, folder, "lineitem")
    flag, day = F.col("l_returnflag").alias("Flag"), F.col("l_shipdate")

    def source(value, where=None):
        kept = lines if where is None else lines.filter(where)
        return kept.select(month_start(day).alias("Date"), flag, value.cast("decimal(24,4)").alias("Value"))

    sources = {
        "Gross": source(price),
        "Kept": source(price, F.col("l_returnflag") != "R"),
        "Net": source(price * (1 - discount)),
        "Taxed": source(price * (1 + tax), day < F.lit("2001-01-01").cast("timestamp_ntz")),
    }
    return to_double(reconcile.reconcile_chain(sources, ["Date", "Flag"]))


@query(
    "reconcile_rollup",
    f"""
    WITH x AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date", 'USD' AS "Metric",
                      '-1' AS "Product_ID", sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
               FROM orders GROUP BY 1),
    y AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", 'USD' AS "Metric",
                 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
          FROM lineitem GROUP BY 1),
    j AS (SELECT coalesce(x."Date", y."Date") AS "Date", 'USD' AS "Metric", x."Product_ID",
                 x.v AS xv, y.v AS yv, CAST(x.v AS DOUBLE) AS xd, CAST(y.v AS DOUBLE) AS yd
          FROM x FULL JOIN y ON x."Date" = y."Date")
    SELECT "Date", "Metric", "Product_ID", {difference_sql("rounded")} FROM j
    """,
)
def reconcile_rollup(spark, folder):
    """A source without products against one with products."""
    orders, lines = _sides(spark, folder)
    coarse = orders.select("Date", "Metric", F.lit("-1").alias("Product_ID"), "Value")
    return to_double(reconcile.reconcile_rollup(coarse, lines, ["Date", "Metric"], carry=["Product_ID"]))


@query(
    "labelled_union",
    f"""
    WITH {_SIDES}
    SELECT 'Absolute' AS "Validation", "Date", "Status", "Metric", {difference_sql("abs")} FROM j
    UNION ALL
    SELECT 'Signed', "Date", "Status", "Metric", {difference_sql("signed")} FROM j
    """,
)
def labelled_union(spark, folder):
    left, right = _sides(spark, folder)
    frames = {
        label: to_double(reconcile.reconcile(left, right, KEYS, mode))
        for label, mode in (("Absolute", "abs"), ("Signed", "signed"))
    }
    return reconcile.labelled_union(frames)


@query(
    "keep_differences",
    f"""
    WITH {_CHAIN_SOURCES}, j AS ({_pair_sql("Gross vs Kept", "gross", "kept")})
    SELECT * FROM (SELECT "Comparativa", "Date", "Flag", {difference_sql("rounded")} FROM j)
    WHERE "Motivo" IS DISTINCT FROM 'Sin diferencias'
    """,
)
def keep_differences(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        month_start("l_shipdate").alias("Date"),
        F.col("l_returnflag").alias("Flag"),
        F.col("l_extendedprice").cast(MONEY).alias("Value"),
    )
    sources = {"Gross": lines, "Kept": lines.filter(F.col("Flag") != "R")}
    compared = reconcile.reconcile_chain(sources, ["Date", "Flag"])
    return to_double(reconcile.keep_differences(compared))


_MEMBERSHIP_LABELS = {
    quality.BOTH: "En ambas fuentes de datos",
    quality.LEFT_ONLY: "En envíos, pero no en catálogo",
    quality.RIGHT_ONLY: "En catálogo, pero no en envíos",
}
_MEMBERSHIP_CASE = """
    CASE WHEN l.k IS NOT NULL AND r.k IS NOT NULL THEN 'En ambas fuentes de datos'
         WHEN r.k IS NULL THEN 'En envíos, pero no en catálogo'
         ELSE 'En catálogo, pero no en envíos' END AS "Status"
"""


@query(
    "membership",
    f"""
    WITH l AS (SELECT l_partkey AS k, min(l_suppkey) AS first_supplier FROM lineitem
               WHERE l_returnflag = 'R' AND l_linestatus = 'O' GROUP BY 1),
    r AS (SELECT p_partkey AS k, p_brand, p_type FROM part WHERE p_size > 25)
    SELECT coalesce(l.k, r.k) AS product, first_supplier, p_brand, p_type, {_MEMBERSHIP_CASE}
    FROM l FULL JOIN r ON l.k = r.k
    """,
)
def membership(spark, folder):
    """Returned products against the catalogue of large ones, one row per product."""
    shipped = (
        table(spark, folder, "lineitem")
        .filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
        .select(F.col("l_partkey").alias("product"), F.col("l_suppkey").alias("first_supplier"))
    )
    catalogue = (
        table(spark, folder, "part")
        .filter(F.col("p_size") > 25)
        .select(F.col("p_partkey").alias("product"), "p_brand", "p_type")
    )
    return quality.membership_by_key(shipped, catalogue, ["product"], _MEMBERSHIP_LABELS)


@query(
    "membership_rows",
    f"""
    WITH l AS (SELECT DISTINCT nullif(l_suppkey, 7) AS k, l_returnflag AS flag, l_linestatus AS line_status
               FROM lineitem WHERE l_linestatus = 'F'),
    r AS (SELECT DISTINCT nullif(s_suppkey, 7) AS k FROM supplier WHERE s_acctbal > 0
          UNION SELECT -1),
    lm AS (SELECT coalesce(k, -99) AS k, k AS supplier, flag, line_status FROM l),
    rm AS (SELECT coalesce(k, -99) AS k, k AS supplier FROM r)
    SELECT CASE WHEN l.k IS NOT NULL THEN l.supplier ELSE r.supplier END AS supplier, flag, line_status, {_MEMBERSHIP_CASE}
    FROM lm l FULL JOIN rm r ON l.k = r.k
    """,
)
def membership_rows(spark, folder):
    """Every distinct shipped combination against a list of suppliers; null keys meet."""
    shipped = (
        table(spark, folder, "lineitem")
        .filter(F.col("l_linestatus") == "F")
        .select(
            F.nullif("l_suppkey", F.lit(7)).alias("supplier"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("line_status"),
        )
    )
    suppliers = table(spark, folder, "supplier").filter(F.col("s_acctbal") > 0)
    listed = suppliers.select(F.nullif("s_suppkey", F.lit(7)).alias("supplier")).unionByName(
        suppliers.agg(F.lit(-1).cast("long").alias("supplier"))
    )
    return quality.membership_by_row(shipped, listed, ["supplier"], _MEMBERSHIP_LABELS)


@query(
    "multi_parent_check",
    """
    WITH p AS (SELECT p_brand || '/' || CAST(p_size AS VARCHAR) AS child, nullif(p_type, 'SMALL') AS parent
               FROM part),
    n AS (SELECT child, count(DISTINCT parent) AS parents FROM p GROUP BY 1)
    SELECT p.child, p.parent,
           CASE WHEN parents > 1 THEN 'Más de 1 molecula asociada' ELSE 'Okay' END AS "Status"
    FROM p JOIN n ON p.child = n.child
    """,
)
def multi_parent_check(spark, folder):
    parts = table(spark, folder, "part").select(
        F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("child"),
        F.nullif("p_type", F.lit("SMALL")).alias("parent"),
    )
    return quality.multi_parent_check(parts, "child", "parent")


@query(
    "period_membership",
    """
    WITH f AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, l_partkey, l_returnflag FROM lineitem),
    b AS (SELECT max(m) AS now, CAST(max(m) - INTERVAL 1 MONTH AS DATE) AS before FROM f),
    c AS (SELECT DISTINCT l_partkey, l_returnflag FROM f WHERE m = (SELECT now FROM b)),
    p AS (SELECT DISTINCT l_partkey, l_returnflag FROM f WHERE m = (SELECT before FROM b))
    SELECT l_partkey, l_returnflag, 'No Report' AS "Status" FROM (SELECT * FROM p EXCEPT SELECT * FROM c)
    UNION ALL
    SELECT l_partkey, l_returnflag, 'New Report' FROM (SELECT * FROM c EXCEPT SELECT * FROM p)
    """,
)
def period_membership(spark, folder):
    lines = table(spark, folder, "lineitem")
    return quality.period_membership(lines, ["l_partkey", "l_returnflag"], "l_shipdate", days=True)
