"""Scans, filters, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.dates import month_start
from cotejo.functions.numbers import MONEY
from cotejo.operators import aggregates, filters, joins, reshape
from cotejo.operators.clean import SourceSpec, clean_source
from cotejo.plans.catalog import query, table


@query(
    "scan_project",
    """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no,
           l_quantity AS units
    FROM lineitem
    """,
)
def scan_project(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnsRenamed(
        {"l_orderkey": "order_id", "l_partkey": "product_id", "l_linenumber": "line_no", "l_quantity": "units"}
    )
    return lines.select("order_id", "product_id", "line_no", "units")


@query(
    "isin_filter",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def isin_filter(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "semi_filter",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
    """,
)
def semi_filter(spark, folder):
    promo = table(spark, folder, "part").filter(F.col("p_type") == "PROMO")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.keep_known(lines, promo.select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"])


@query(
    "anti_filter",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    """,
)
def anti_filter(spark, folder):
    pending = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.keep_unknown(customers, pending.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "optional_filters",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
    """,
)
def optional_filters(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return filters.optional_filters(orders, o_orderstatus="O", o_orderkey=None, o_orderpriority="5-LOW")


@query(
    "compound_filter",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
    WHERE l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus IN ('O'))
    """,
)
def compound_filter(spark, folder):
    lines = table(spark, folder, "lineitem")
    wanted = (F.col("l_returnflag") == "R") | (
        (F.col("l_returnflag") == "A") & F.col("l_linestatus").isin("O")
    )
    return lines.filter(wanted).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query(
    "recent_years",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units
    FROM lineitem
    WHERE year(l_shipdate) >= (SELECT max(year(l_shipdate)) - 2 FROM lineitem)
    GROUP BY 1, 2
    """,
)
def recent_years(spark, folder):
    recent = filters.recent_years(table(spark, folder, "lineitem"), "l_shipdate", 2)
    return recent.groupBy(F.year("l_shipdate").alias("ship_year"), "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("units")
    )


@query(
    "last_n_periods",
    """
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice FROM orders)
    SELECT month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(*) AS orders
    FROM m
    WHERE month IN (SELECT DISTINCT month FROM m ORDER BY month DESC LIMIT 12)
    GROUP BY month
    """,
)
def last_n_periods(spark, folder):
    orders = filters.last_n_months(table(spark, folder, "orders"), "o_orderdate", 12)
    return (
        orders.groupBy(month_start("o_orderdate").alias("month"))
        .agg(
            F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("total"),
            F.count("*").alias("orders"),
        )
    )


@query(
    "member_filter",
    """
    SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
    GROUP BY 1, 2
    """,
)
def member_filter(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus")
    changed = filters.select_members(
        orders, "o_orderpriority", ["5-LOW"], selected=["1-URGENT", "2-HIGH"], remove=["2-HIGH"]
    )
    return changed.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("orders"))


@query(
    "member_filter_unknown",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('5-LOW', '9-NEVER')
      AND EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '9-NEVER')
    """,
)
def member_filter_unknown(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return filters.select_members(orders, "o_orderpriority", ["5-LOW", "9-NEVER"])


@query("distinct_values", "SELECT DISTINCT p_name FROM part")
def distinct_values(spark, folder):
    return aggregates.distinct_values(table(spark, folder, "part"), "p_name")


@query(
    "limit_n",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 200
    """,
)
def limit_n(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return filters.top_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 200)


@query(
    "drop_total_row",
    """
    SELECT o_orderpriority AS priority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """,
)
def drop_total_row(spark, folder):
    """A report with a total row for every status and one over all, and the same without."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast(MONEY).alias("total")
    )
    report = (
        orders.rollup("priority")
        .agg(F.sum("total").alias("total"))
        .withColumn("priority", F.coalesce("priority", F.lit("Grand Total")))
    )
    return filters.drop_totals(report, "priority", null_is_total=True).withColumn("total", F.col("total").cast("double"))


@query(
    "conditional_update",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('4-NOT SPECIFIED') THEN 'Sin Identificar'
                ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def conditional_update(spark, folder):
    open_ended = (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("4-NOT SPECIFIED")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(open_ended, "Sin Identificar").otherwise(F.col("o_orderpriority")).alias("priority"),
    )


@query(
    "left_enrich",
    """
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
    """,
)
def left_enrich(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice"
    )
    customers = table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
    joined = joins.lookup_join(orders, customers.select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"])
    return joined.drop("c_custkey")


@query(
    "left_enrich_salted",
    """
    SELECT o_orderkey, o_orderstatus, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def left_enrich_salted(spark, folder):
    """The same with the rows of hot customers spread over 16 tasks."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus"
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return joins.lookup_join(orders, customers, ["c_custkey"], salts=16).drop("c_custkey")


@query(
    "left_enrich_multi",
    """
    WITH shipped AS (
        SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units
        FROM lineitem GROUP BY 1, 2),
    returned AS (
        SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS returned
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
    SELECT s.l_suppkey, s.l_partkey, s.units, r.returned
    FROM shipped s LEFT JOIN returned r ON s.l_suppkey = r.l_suppkey AND s.l_partkey = r.l_partkey
    """,
)
def left_enrich_multi(spark, folder):
    lines = table(spark, folder, "lineitem")
    keys = ["l_suppkey", "l_partkey"]
    shipped = aggregates.group_sum(lines, keys, {"units": "l_quantity"}, MONEY)
    returned = aggregates.group_sum(
        lines.filter(F.col("l_returnflag") == "R"), keys, {"returned": "l_quantity"}, MONEY
    )
    joined = joins.lookup_join(shipped, returned, keys)
    return joined.select(*keys, F.col("units").cast("double"), F.col("returned").cast("double"))


@query(
    "dict_lookup",
    """
    WITH entries AS (
        SELECT o_custkey, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
        FROM orders)
    SELECT c_custkey, o_orderpriority AS last_priority
    FROM customer LEFT JOIN entries ON c_custkey = o_custkey AND n = 1
    """,
)
def dict_lookup(spark, folder):
    """Orders as a dictionary customer -> priority with repeated keys, of which the last counts."""
    customers = table(spark, folder, "customer").select("c_custkey")
    orders = table(spark, folder, "orders")
    return joins.dict_lookup(
        customers, "c_custkey", orders, "o_custkey", "o_orderpriority", "last_priority",
        order=["o_orderdate", "o_orderkey"],
    )


@query(
    "full_join_null_safe",
    """
    WITH a AS (SELECT nullif(o_orderstatus, 'P') AS status,
                      CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders
               FROM orders GROUP BY 1, 2),
    b AS (SELECT nullif(l_linestatus, 'F') AS status,
                 CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS lines
          FROM lineitem GROUP BY 1, 2)
    SELECT coalesce(a.status, b.status) AS status, coalesce(a.month, b.month) AS month, orders, lines
    FROM a FULL JOIN b ON a.status IS NOT DISTINCT FROM b.status AND a.month = b.month
    """,
)
def full_join_null_safe(spark, folder):
    a = (
        table(spark, folder, "orders")
        .groupBy(F.nullif("o_orderstatus", F.lit("P")).alias("status"), month_start("o_orderdate").alias("month"))
        .agg(F.count("*").alias("orders"))
    )
    b = (
        table(spark, folder, "lineitem")
        .groupBy(F.nullif("l_linestatus", F.lit("F")).alias("status"), month_start("l_shipdate").alias("month"))
        .agg(F.count("*").alias("lines"))
    )
    return joins.full_join_null_safe(a, b, ["status", "month"])


@query(
    "group_sum",
    """
    WITH o AS (SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_orderstatus,
                      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price
               FROM orders)
    SELECT priority, o_orderstatus, CAST(coalesce(sum(price), 0) AS DOUBLE) AS total
    FROM o WHERE priority IS NOT NULL GROUP BY 1, 2
    """,
)
def group_sum(spark, folder):
    """Null keys are dropped, and a group of nulls sums to 0."""
    orders = table(spark, folder, "orders").select(
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    sums = aggregates.group_sum(orders, ["priority", "o_orderstatus"], {"total": "price"}, MONEY)
    return sums.withColumn("total", F.col("total").cast("double"))


@query(
    "chunked_sum",
    """
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_partkey,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS units,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem GROUP BY 1, 2
    """,
)
def chunked_sum(spark, folder):
    """Sums of a file too large for memory: partial sums per partition, then final sums."""
    lines = table(spark, folder, "lineitem").withColumn("month", month_start("l_shipdate"))
    sums = aggregates.group_sum(
        lines, ["month", "l_partkey"], {"units": "l_quantity", "amount": "l_extendedprice"}, MONEY
    )
    return sums.select(
        "month", "l_partkey", F.col("units").cast("double"), F.col("amount").cast("double")
    )


@query(
    "distinct_on",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) AS order_date
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                               ORDER BY o_orderdate, o_orderkey) = 1
    """,
)
def distinct_on(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return aggregates.distinct_on(orders, ["o_custkey", "o_orderpriority"], ["order_date", "o_orderkey"])


@query(
    "melt_sum",
    """
    WITH s AS (
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", l_returnflag,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "QTY",
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "USD"
        FROM lineitem GROUP BY 1, 2)
    SELECT "Date", l_returnflag, 'QTY' AS "Metric", "QTY" AS "Value" FROM s
    UNION ALL SELECT "Date", l_returnflag, 'USD', "USD" FROM s
    """,
)
def melt_sum(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        month_start("l_shipdate").alias("Date"),
        "l_returnflag",
        F.col("l_quantity").alias("QTY"),
        F.col("l_extendedprice").alias("USD"),
    )
    long = reshape.melt_sum(lines, ["Date", "l_returnflag"], ["QTY", "USD"], exact=MONEY)
    return long.withColumn("Value", F.col("Value").cast("double"))


@query(
    "melt",
    """
    SELECT p_partkey, 'p_size' AS "Metric", CAST(p_size AS DOUBLE) AS "Value" FROM part
    UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
    """,
)
def melt(spark, folder):
    parts = table(spark, folder, "part").withColumn("p_size", F.col("p_size").cast("double"))
    return reshape.melt(parts, ["p_partkey"], ["p_size", "p_retailprice"])


@query(
    "clean_source",
    """
    WITH s AS (
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", CAST(l_partkey AS VARCHAR) AS "Product_ID",
               sum(CAST(l_quantity AS DECIMAL(18,2))) AS u, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS m
        FROM lineitem
        WHERE l_returnflag <> 'R'
          AND year(l_shipdate) >= (SELECT max(year(l_shipdate)) - 4 FROM lineitem WHERE l_returnflag <> 'R')
        GROUP BY 1, 2)
    SELECT "Date", 'Normales' AS "Institucion", "Product_ID", 'Units' AS "Metric", CAST(u AS DOUBLE) AS "Value" FROM s
    UNION ALL SELECT "Date", 'Normales', "Product_ID", 'MXN', CAST(m AS DOUBLE) FROM s
    """,
)
def clean_source_query(spark, folder):
    spec = SourceSpec(
        rename={"l_partkey": "Product_ID", "l_quantity": "Units", "l_extendedprice": "MXN"},
        derive={"Product_ID": F.col("Product_ID").cast("string"), "Date": month_start("l_shipdate")},
        raw="l_shipdate",
        literals={"Institucion": "Normales"},
        where=F.col("l_returnflag") != "R",
        back=4,
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Units", "MXN"],
        exact=MONEY,
    )
    long = clean_source(table(spark, folder, "lineitem"), spec)
    return long.withColumn("Value", F.col("Value").cast("double"))
