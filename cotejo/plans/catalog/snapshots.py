"""Live against frozen data, the ledger, and stored SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.dates import month_start, month_text
from cotejo.functions.numbers import MONEY
from cotejo.operators import reshape, snapshots
from cotejo.plans.catalog import query, table
from cotejo.sources.delimited import unify_dates
from cotejo.operators.filters import exclude_month
from cotejo.sources.sql_files import run_sql_file

# The line items stand for the live table. A freeze holds what had been shipped by its date;
# it kept the gross price of returned lines, which are net in the live table. Suppliers are
# the sites; the older freeze of the sites lacks those in debt.
FREEZES = ("2000-12-15", "2001-06-20")
ORIGIN = snapshots.Origin("ALTAS", {"piezas": "PIEZAS", "importe": "IMPORTE"}, site="clues", brand="marca")

_LIVE = """
    base AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_shipdate AS DATE) AS day,
                    l_suppkey AS clues, l_returnflag AS marca,
                    CAST(l_quantity AS DECIMAL(28,6)) AS piezas,
                    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                    CAST(l_discount AS DECIMAL(5,2)) AS discount
             FROM lineitem),
    live AS (SELECT month, clues, marca, piezas,
                    CASE WHEN marca = 'R' THEN price * (1 - discount) ELSE CAST(price AS DECIMAL(24,4)) END AS importe
             FROM base),
    sites AS (SELECT s_suppkey AS clues, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS institucion FROM supplier)
"""


def _totals_sql(freeze: str, name: str) -> str:
    """Totals of the live table and of one freeze, as common table expressions."""
    frozen_sites = "sites" if freeze == FREEZES[-1] else (
        "(SELECT s_suppkey AS clues, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS institucion "
        "FROM supplier WHERE s_acctbal >= 0)"
    )
    return f"""
    {name}_frozen AS (SELECT month, clues, marca, piezas, CAST(price AS DECIMAL(24,4)) AS importe FROM base
                      WHERE day <= DATE '{freeze}'),
    {name}_s AS (SELECT month, institucion, marca, sum(piezas) AS p, sum(importe) AS i
                 FROM live JOIN sites USING (clues) GROUP BY 1, 2, 3),
    {name}_f AS (SELECT month, institucion, marca, sum(piezas) AS p, sum(importe) AS i
                 FROM {name}_frozen JOIN {frozen_sites} x USING (clues) GROUP BY 1, 2, 3),
    {name}_j AS (SELECT coalesce(s.month, f.month) AS "DATE", coalesce(s.institucion, f.institucion) AS "INSTITUCION",
                        coalesce(s.marca, f.marca) AS "MARCA",
                        CASE WHEN s.month IS NOT NULL THEN (SELECT max(month) FROM live) END AS "DATE_STANDARD",
                        CASE WHEN f.month IS NOT NULL THEN '{freeze}' END AS "DATE_FREEZE",
                        s.p AS sp, s.i AS si, f.p AS fp, f.i AS fi
                 FROM {name}_s s FULL JOIN {name}_f f
                   ON s.month = f.month AND s.institucion = f.institucion AND s.marca = f.marca),
    {name} AS (
        SELECT "DATE", 'ALTAS' AS "ORIGEN", "INSTITUCION", "MARCA", 'PIEZAS' AS "VARIABLE",
               "DATE_STANDARD", "DATE_FREEZE",
               round_even(sp, 2) AS ts, round_even(fp, 2) AS tf FROM {name}_j
        UNION ALL
        SELECT "DATE", 'ALTAS', "INSTITUCION", "MARCA", 'IMPORTE', "DATE_STANDARD", "DATE_FREEZE",
               round_even(si, 2), round_even(fi, 2) FROM {name}_j)
    """


_DIFF_COLUMNS = """
    "DATE", "ORIGEN", "INSTITUCION", "MARCA", "VARIABLE",
    CAST(ts AS DOUBLE) AS "TOTAL_STANDARD", CAST(tf AS DOUBLE) AS "TOTAL_FREEZE",
    CAST(abs(ts - tf) AS DOUBLE) AS "DIFF ABS",
    CASE WHEN ts <> 0 THEN round_even(CAST(tf AS DOUBLE) / CAST(ts AS DOUBLE) - 1, 10) END AS "DIFF%",
    CASE WHEN ts IS NULL OR tf IS NULL THEN 'Un origen no tiene información' ELSE 'Sin identificar' END AS "MOTIVO"
"""


def _tables(spark, folder, freezes):
    lines, suppliers = table(spark, folder, "lineitem"), table(spark, folder, "supplier")
    price = F.col("l_extendedprice").cast(MONEY)
    net = (price * (1 - F.col("l_discount").cast("decimal(5,2)"))).cast("decimal(24,4)")

    def as_text(frame, amount, *extra):
        return frame.select(
            F.year("l_shipdate").cast("string").alias("annual"),
            F.month("l_shipdate").cast("string").alias("mes"),
            F.col("l_suppkey").cast("string").alias("clues"),
            F.col("l_returnflag").alias("marca"),
            F.col("l_quantity").cast("string").alias("piezas"),
            amount.cast("string").alias("importe"),
            *extra,
        )

    live = as_text(lines, F.when(F.col("l_returnflag") == "R", net).otherwise(price.cast("decimal(24,4)")))
    sites = suppliers.select(
        F.col("s_suppkey").cast("string").alias("clave_clues"),
        F.concat(F.lit("NATION_"), "s_nationkey").alias("institucion"),
        "s_acctbal",
    )
    frozen, frozen_sites = None, None
    for freeze in freezes:
        stamp = F.lit(freeze).alias("ref_frz_dt")
        one = as_text(lines.filter(F.to_date("l_shipdate") <= F.lit(freeze).cast("date")), price, stamp)
        known = sites if freeze == FREEZES[-1] else sites.filter(F.col("s_acctbal") >= 0)
        known = known.select("clave_clues", "institucion", stamp)
        frozen = one if frozen is None else frozen.unionByName(one)
        frozen_sites = known if frozen_sites is None else frozen_sites.unionByName(known)
    return live, frozen, sites.select("clave_clues", "institucion"), frozen_sites


def _totals(spark, folder, freezes=FREEZES):
    return snapshots.snapshot_totals(*_tables(spark, folder, freezes), ORIGIN)


@query(
    "snapshot_compare",
    f"""
    WITH {_LIVE}, {_totals_sql(FREEZES[-1], "t")}
    SELECT "DATE", "ORIGEN", "INSTITUCION", "MARCA", "VARIABLE", "DATE_STANDARD", "DATE_FREEZE",
           CAST(ts AS DOUBLE) AS "TOTAL_STANDARD", CAST(tf AS DOUBLE) AS "TOTAL_FREEZE"
    FROM t
    """,
)
def snapshot_compare(spark, folder):
    return _totals(spark, folder)


@query(
    "snapshot_diff",
    f"""
    WITH {_LIVE}, {_totals_sql(FREEZES[-1], "t")}
    SELECT {_DIFF_COLUMNS} FROM t WHERE abs(ts - tf) IS DISTINCT FROM 0
    """,
)
def snapshot_diff(spark, folder):
    return snapshots.snapshot_diff(_totals(spark, folder))


@query(
    "diff_ledger",
    f"""
    WITH {_LIVE}, {_totals_sql(FREEZES[0], "a")}, {_totals_sql(FREEZES[1], "b")},
    old AS (SELECT {_DIFF_COLUMNS}, 'run 1' AS "FECHA IDENTIFICACION" FROM a WHERE abs(ts - tf) IS DISTINCT FROM 0),
    new AS (SELECT {_DIFF_COLUMNS}, 'run 2' AS "FECHA IDENTIFICACION" FROM b WHERE abs(ts - tf) IS DISTINCT FROM 0),
    both_runs AS (SELECT *, 0 AS age FROM new UNION ALL SELECT *, 1 FROM old)
    SELECT * EXCLUDE (age) FROM both_runs
    QUALIFY row_number() OVER (
        PARTITION BY "DATE", "ORIGEN", "INSTITUCION", "VARIABLE", "TOTAL_STANDARD", "TOTAL_FREEZE", "DIFF ABS", "DIFF%"
        ORDER BY age, "MARCA") = 1
    """,
)
def diff_ledger(spark, folder):
    """Differences against the newest freeze, added to those found against the one before."""
    old = snapshots.snapshot_diff(_totals(spark, folder, FREEZES[:1]), F.lit("run 1"))
    new = snapshots.snapshot_diff(_totals(spark, folder), F.lit("run 2"))
    return snapshots.diff_ledger(new, old)


@query(
    "pivot_sum_max",
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS priority,
           max(CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END) AS "DATE_STANDARD",
           max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS "DATE_FREEZE",
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "TOTAL_STANDARD",
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "TOTAL_FREEZE"
    FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1, 2
    """,
)
def pivot_sum_max(spark, folder):
    long = table(spark, folder, "orders").select(
        month_start("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("FUENTE"),
        F.col("o_totalprice").cast(MONEY).alias("TOTAL"),
        F.to_date("o_orderdate").alias("MAX_DATE"),
    )
    wide = reshape.pivot_sum_max(long, ["month", "priority"], "FUENTE", {"O": "STANDARD", "F": "FREEZE"})
    return wide.withColumns({c: F.col(c).cast("double") for c in ("TOTAL_STANDARD", "TOTAL_FREEZE")})


@query(
    "sql_file",
    """
    WITH l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS annual, strftime(l_shipdate, '%Y-%m-01') AS month_date,
                      CAST(l_partkey AS VARCHAR) AS product_id, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day,
                      CAST(l_quantity AS DECIMAL(28,6)) AS units, CAST(l_extendedprice AS DECIMAL(28,6)) AS amount
               FROM lineitem),
    n AS (SELECT * FROM l WHERE flag = 'N' AND day <= DATE '2001-06-20'),
    a AS (SELECT * FROM l WHERE flag = 'A'),
    r AS (SELECT * FROM l WHERE flag = 'R')
    SELECT month_date, institucion, product_id, CAST(sum(units) AS DOUBLE) AS units, CAST(sum(amount) AS DOUBLE) AS amount
    FROM (SELECT *, 'Normales' AS institucion FROM n WHERE annual >= (SELECT max(annual) FROM n) - 4
          UNION ALL SELECT *, 'IMSS' FROM a WHERE annual >= (SELECT max(annual) FROM a) - 2
          UNION ALL SELECT *, 'ISSSTE' FROM r WHERE annual >= (SELECT max(annual) FROM r) - 2)
    GROUP BY 1, 2, 3
    """,
)
def sql_file(spark, folder):
    """The stored statement for deliveries, with the line items in the place of its tables."""
    lines = table(spark, folder, "lineitem")

    def programme(flag):
        return lines.filter(F.col("l_returnflag") == flag).select(
            F.year("l_shipdate").alias("annual"),
            F.month("l_shipdate").cast("string").alias("mes"),
            F.col("l_partkey").cast("string").alias("clave_cbycm"),
            F.col("l_quantity").alias("piezas"),
            F.col("l_extendedprice").alias("importe"),
        )

    regular = lines.filter(F.col("l_returnflag") == "N")
    frozen = None
    for freeze in FREEZES:
        one = regular.filter(F.to_date("l_shipdate") <= F.lit(freeze).cast("date")).select(
            month_text(F.year("l_shipdate"), F.month("l_shipdate")).alias("date"),
            F.col("l_partkey").cast("string").alias("product_code"),
            F.col("l_quantity").cast("string").alias("sales_units"),
            F.col("l_extendedprice").cast(MONEY).cast("string").alias("sales_values"),
            F.lit(freeze).alias("ref_frz_dt"),
        )
        frozen = one if frozen is None else frozen.unionByName(one)
    result = run_sql_file(
        spark,
        "lake_deliveries.sql",
        {"frozen_deliveries": frozen, "first_programme": programme("A"), "second_programme": programme("R")},
        {"regular_years": 4, "programme_years": 2},
    )
    return result.withColumns({c: F.col(c).cast("double") for c in ("units", "amount")})


@query(
    "multi_file_union",
    """
    SELECT o_orderkey, o_orderpriority || '.txt' AS source_file, CAST(o_orderdate AS DATE) AS order_date
    FROM orders
    WHERE NOT (o_orderpriority = '5-LOW' AND year(o_orderdate) = 1998 AND month(o_orderdate) = 5)
    """,
)
def multi_file_union(spark, folder):
    """Orders as deliveries of five files, of which two write dates with dashes; one month of
    one file is left out."""
    day = F.col("o_orderdate")
    dashed = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    delivered = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit(".txt")).alias("source_file"),
        F.when(dashed, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "yyyyMMdd")).alias("order_date"),
    )
    unified = unify_dates(delivered, "order_date")
    return exclude_month(unified, "order_date", 1998, 5, F.col("source_file") == "5-LOW.txt")


@query(
    "sql_file_awards",
    """
    WITH l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS annual, strftime(l_shipdate, '%Y-%m-01') AS month_date,
                      l_suppkey, CAST(l_partkey AS VARCHAR) AS product_id,
                      CAST(l_quantity AS DECIMAL(28,6)) AS units, CAST(l_extendedprice AS DECIMAL(28,6)) AS amount
               FROM lineitem)
    SELECT month_date, n_name AS institucion, product_id, CAST(sum(units) AS DOUBLE) AS units, CAST(sum(amount) AS DOUBLE) AS amount
    FROM l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    WHERE annual >= (SELECT max(annual) FROM l) - 2 AND n_name IN ('NATION_1', 'NATION_2', 'NATION_3')
    GROUP BY 1, 2, 3
    """,
)
def sql_file_awards(spark, folder):
    awards = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("annual"),
        F.month("l_shipdate").cast("string").alias("mes"),
        F.col("l_suppkey").alias("clave_clues"),
        F.col("l_partkey").cast("string").alias("clave_cbycm"),
        F.col("l_quantity").alias("piezas"),
        F.col("l_extendedprice").alias("importe_max"),
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("institucion")
    )
    sites = table(spark, folder, "supplier").join(nations, "s_nationkey").select(
        F.col("s_suppkey").alias("clave_clues"), "institucion"
    )
    wanted = F.array(*[F.lit(n) for n in ("NATION_1", "NATION_2", "NATION_3")])
    result = run_sql_file(
        spark, "lake_awards.sql", {"awards": awards, "sites": sites}, {"years": 2, "institutions": wanted}
    )
    return result.withColumns({c: F.col(c).cast("double") for c in ("units", "amount")})


@query(
    "sql_file_consumption",
    """
    WITH l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS annual, strftime(l_shipdate, '%Y-%m-01') AS month_date,
                      CAST(l_partkey AS VARCHAR) AS product_id, l_returnflag AS flag,
                      CAST(l_quantity AS DECIMAL(28,6)) AS stock, CAST(l_extendedprice AS DECIMAL(28,6)) AS price,
                      CAST(l_tax AS DECIMAL(28,6)) AS tax, CAST(l_discount AS DECIMAL(28,6)) AS discount
               FROM lineitem)
    SELECT month_date, CASE flag WHEN 'A' THEN 'IMSS' WHEN 'R' THEN 'ISSSTE' ELSE 'CENSIDA' END AS institucion,
           product_id, CAST(sum(stock) AS DOUBLE) AS stock,
           CAST(sum(CASE flag WHEN 'A' THEN price WHEN 'R' THEN tax ELSE discount END) AS DOUBLE) AS consumption
    FROM l WHERE annual >= (SELECT max(annual) FROM l) - 4
    GROUP BY 1, 2, 3
    """,
)
def sql_file_consumption(spark, folder):
    lines = table(spark, folder, "lineitem")

    def programme(flag, column, measure):
        return lines.filter(F.col("l_returnflag") == flag).select(
            F.year("l_shipdate").cast("string").alias("annual"),
            F.month("l_shipdate").cast("string").alias("mes"),
            F.col("l_partkey").cast("string").alias("clave_cbycm"),
            F.col("l_quantity").alias("inventario"),
            F.col(measure).alias(column),
        )

    result = run_sql_file(
        spark,
        "lake_consumption.sql",
        {
            "first_table": programme("A", "cpm_r", "l_extendedprice"),
            "second_table": programme("R", "dpn", "l_tax"),
            "third_table": programme("N", "consumo_autorizado", "l_discount"),
        },
        {"years": 4},
    )
    return result.withColumns({c: F.col(c).cast("double") for c in ("stock", "consumption")})
