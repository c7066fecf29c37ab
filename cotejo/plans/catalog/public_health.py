"""Master refresh, retroactive differences, snapshots, shares and allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.dates import month_start
from cotejo.functions.numbers import MONEY
from cotejo.operators import filters, quality, refresh, shares
from cotejo.operators.aggregates import group_sum
from cotejo.operators.joins import lookup_join
from cotejo.plans.catalog import query, table
from cotejo.sources import snapshot_store

_ORDERS = """
    o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Fecha", o_orderkey, o_orderstatus,
                 o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        month_start("o_orderdate").alias("Fecha"),
        "o_orderdate",
        "o_orderkey",
        "o_orderstatus",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )


@query(
    "window_refresh",
    f"""
    WITH {_ORDERS},
    latest AS (SELECT "Fecha", o_orderkey, price * 2 AS price FROM o
               WHERE "Fecha" > (SELECT max("Fecha") - INTERVAL 12 MONTH FROM o) AND o_orderstatus <> 'P')
    SELECT "Fecha", o_orderkey, CAST(price AS DOUBLE) AS price FROM o
    WHERE "Fecha" < (SELECT min("Fecha") FROM latest)
    UNION ALL SELECT "Fecha", o_orderkey, CAST(price AS DOUBLE) FROM latest
    """,
)
def window_refresh(spark, folder):
    """The last twelve months delivered again, without pending orders and with new prices."""
    master = _orders(spark, folder)
    first = filters.month_bound(master, "o_orderdate", master, F.add_months(F.max("Fecha"), -11))
    latest = filters.in_months(master, "o_orderdate", first).filter(F.col("o_orderstatus") != "P")
    latest = latest.select("Fecha", "o_orderkey", (F.col("price") * 2).cast(MONEY).alias("price"))
    whole = master.select("Fecha", "o_orderdate", "o_orderkey", "price")
    refreshed = refresh.window_refresh(whole, latest, raw="o_orderdate")
    return refreshed.withColumn("price", F.col("price").cast("double"))


@query(
    "retro_diff",
    f"""
    WITH {_ORDERS},
    c AS (SELECT "Fecha", priority, sum(price) AS v FROM o GROUP BY 1, 2),
    p AS (SELECT "Fecha", priority, sum(price) AS v FROM o
          WHERE o_orderstatus <> 'P' OR "Fecha" < DATE '2000-01-01' GROUP BY 1, 2)
    SELECT c."Fecha", c.priority, CAST(c.v AS DOUBLE) AS "Registros ultimo mes",
           CAST(p.v AS DOUBLE) AS "Registros mes anterior", CAST(c.v - p.v AS DOUBLE) AS "Diferencia"
    FROM c LEFT JOIN p ON c."Fecha" = p."Fecha" AND c.priority = p.priority
    WHERE c.v - p.v <> 0
    """,
)
def retro_diff(spark, folder):
    """Pending orders were added to the months since 2000 after the previous version."""
    current = _orders(spark, folder)
    previous = current.filter((F.col("o_orderstatus") != "P") | (F.col("Fecha") < F.lit("2000-01-01").cast("date")))
    changed = refresh.retro_diff(current, previous, ["Fecha", "priority"], "price")
    return changed.select(
        "Fecha",
        "priority",
        *[F.col(f"`{c}`").cast("double").alias(c) for c in ("Registros ultimo mes", "Registros mes anterior", "Diferencia")],
    )


def _snapshots(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias(snapshot_store.SNAPSHOT)
    )


@query(
    "nth_snapshot",
    """
    WITH s AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS snapshot_month FROM orders)
    SELECT * FROM s WHERE snapshot_month = (
        SELECT DISTINCT snapshot_month FROM s ORDER BY 1 DESC LIMIT 1 OFFSET 1)
    """,
)
def nth_snapshot(spark, folder):
    return snapshot_store.nth_newest(_snapshots(spark, folder), 2, raw="o_orderdate").drop("o_orderdate")


@query(
    "snapshot_retention",
    """
    WITH s AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS snapshot_month FROM orders)
    SELECT * FROM s WHERE snapshot_month IN (SELECT DISTINCT snapshot_month FROM s ORDER BY 1 DESC LIMIT 12)
    """,
)
def snapshot_retention(spark, folder):
    return snapshot_store.keep_newest(_snapshots(spark, folder), 12, raw="o_orderdate").drop("o_orderdate")


# Brands are the ingredients, part types the indications, part names the products, quantities
# the deliveries. The ratio is the size of the smallest part; it is unknown from 25 on.
_SHARES = """
    q AS (SELECT l_partkey, CAST(date_trunc('year', l_shipdate) AS DATE) AS year_start,
                 sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY 1, 2),
    d AS (SELECT p_brand AS brand, p_type AS kind, p_name AS product, year_start, qty
          FROM q JOIN part ON l_partkey = p_partkey),
    c AS (SELECT brand, kind, sum(qty) AS v FROM d GROUP BY 1, 2),
    share AS (SELECT brand, kind, CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY brand) AS DOUBLE) AS "Indice"
              FROM c),
    ratios AS (SELECT p_brand AS brand, p_type AS kind, p_name AS product,
                      CASE WHEN min(p_size) < 25 THEN CAST(min(p_size) AS DOUBLE) END AS "Ratio"
               FROM part GROUP BY 1, 2, 3),
    facts AS (SELECT year_start, brand, product, CAST(sum(qty) AS DOUBLE) AS units FROM d GROUP BY 1, 2, 3),
    allocated AS (
        SELECT f.year_start, f.brand, f.product, s.kind, f.units, s."Indice", r."Ratio",
               f.units * s."Indice" AS "Split", f.units * s."Indice" / r."Ratio" AS "Pacientes Totales"
        FROM facts f LEFT JOIN share s ON f.brand = s.brand
        LEFT JOIN ratios r ON f.brand = r.brand AND s.kind = r.kind AND f.product = r.product)
"""


def _deliveries(spark, folder):
    """Yearly quantity per part, summed before the catalogue is joined."""
    lines = table(spark, folder, "lineitem").withColumn("year_start", F.trunc(F.to_date("l_shipdate"), "year"))
    yearly = group_sum(lines, ["l_partkey", "year_start"], {"qty": "l_quantity"}, MONEY)
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_name").alias("product"),
    )
    return lookup_join(yearly, parts, ["l_partkey"], "inner")


def _ratios(spark, folder):
    return (
        table(spark, folder, "part")
        .groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_name").alias("product"))
        .agg(F.min("p_size").alias("size"))
        .select("brand", "kind", "product", F.when(F.col("size") < 25, F.col("size").cast("double")).alias("Ratio"))
    )


def _allocated(spark, folder, digits):
    deliveries = _deliveries(spark, folder)
    index = shares.share_index(deliveries, "brand", "kind", "qty")
    facts = group_sum(deliveries, ["year_start", "brand", "product"], {"units": "qty"})
    facts = facts.withColumn("units", F.col("units").cast("double"))
    return shares.allocate_share(
        facts, index, _ratios(spark, folder), "brand", "kind", "product", "units", digits=digits
    )


def _rated_keys(spark, folder):
    """One row per brand, product and kind that shares would allocate, with its ratio: the keys
    of the deliveries alone, without years, quantities or shares."""
    delivered = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.min("l_shipdate").alias("first"))
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_name").alias("product"),
    )
    known = lookup_join(delivered, parts, ["l_partkey"], "inner")
    products = known.groupBy("brand", "product").agg(F.min("first").alias("first"))
    keys = lookup_join(products, known.select("brand", "kind").distinct(), ["brand"], "left")
    return lookup_join(keys, _ratios(spark, folder), ["brand", "kind", "product"], "left")


@query("share_index", f'WITH {_SHARES} SELECT brand, kind, "Indice" FROM share')
def share_index(spark, folder):
    return shares.share_index(_deliveries(spark, folder), "brand", "kind", "qty")


@query(
    "allocate_share",
    f"""
    WITH {_SHARES}
    SELECT year_start, brand, product, kind, units, "Indice", "Ratio", "Split", "Pacientes Totales" FROM allocated
    """,
)
def allocate_share(spark, folder):
    return _allocated(spark, folder, None)


@query(
    "allocate_share_rounded",
    f"""
    WITH {_SHARES}
    SELECT year_start, brand, product, kind, round_even("Pacientes Totales", 2) AS "Pacientes Totales" FROM allocated
    """,
)
def allocate_share_rounded(spark, folder):
    return _allocated(spark, folder, 2).select("year_start", "brand", "product", "kind", "Pacientes Totales")


@query(
    "unresolved_keys",
    f"""
    WITH {_SHARES} SELECT DISTINCT brand, kind, product FROM allocated WHERE "Ratio" IS NULL
    """,
)
def unresolved_keys(spark, folder):
    return quality.unresolved_keys(_rated_keys(spark, folder), "Ratio", ["brand", "kind", "product"])


@query(
    "first_unresolved",
    f"""
    WITH {_SHARES} SELECT brand, kind, product, min(year_start) AS year_start FROM allocated
    WHERE "Ratio" IS NULL GROUP BY 1, 2, 3
    """,
)
def first_unresolved(spark, folder):
    return (
        _rated_keys(spark, folder)
        .filter(F.col("Ratio").isNull())
        .select("brand", "kind", "product", F.trunc(F.to_date("first"), "year").alias("year_start"))
    )
