"""Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions import dates, mapping, numbers
from cotejo.functions import text as tx
from cotejo.plans.catalog import query, table

# DuckDB: the same runs of letters, one by one.
_TITLE = (
    "list_aggregate(list_transform(regexp_extract_all(lower({c}), "
    "'([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)'), "
    "lambda x: CASE WHEN x[1] = 'ß' THEN 'Ss' ELSE upper(x[1]) END || x[2:]), 'string_agg', '')"
)
# Example dictionaries.
PRIORITY_CODES = {"1-URGENT": "URG", "2-HIGH": "HIG", "3-MEDIUM": "MED"}
PRODUCT_WORDS = ["widget", "bolt", "anvil"]


@query(
    "title_case",
    f"""
    SELECT c_custkey, {_TITLE.format(c="c_name || ' ' || c_mktsegment || '/x1y o''neil'")} AS title
    FROM customer
    """,
)
def title_case(spark, folder):
    name = F.concat("c_name", F.lit(" "), "c_mktsegment", F.lit("/x1y o'neil"))
    return table(spark, folder, "customer").select("c_custkey", tx.title_case(name).alias("title"))


@query(
    "title_case_documents",
    f"SELECT doc_id, {_TITLE.format(c='text')} AS title FROM documents",
)
def title_case_documents(spark, folder):
    """Whole texts in four languages."""
    return table(spark, folder, "documents").select("doc_id", tx.title_case("text").alias("title"))


@query(
    "title_after_dash",
    f"""
    SELECT o_orderkey, split_part(o_orderpriority, '-', 1) || '-'
           || {_TITLE.format(c="substr(o_orderpriority, instr(o_orderpriority, '-') + 1)")} AS priority
    FROM orders
    """,
)
def title_after_dash(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", tx.title_after_dash("o_orderpriority").alias("priority")
    )


@query(
    "string_clean",
    """
    SELECT c_custkey,
           lower(c_name) AS stripped,
           ltrim(split_part(c_name, '#', 2), '0') AS no_zeros,
           upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS capitalized,
           right(c_name, 8) AS tail,
           left(c_name, 6) AS head,
           'Customer' AS first_part,
           split_part(c_name, '#', 2) || '#x' AS second_part,
           CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN '0' || CAST(c_nationkey AS VARCHAR)
                ELSE CAST(c_nationkey AS VARCHAR) END AS padded
    FROM customer
    """,
)
def string_clean(spark, folder):
    parts = tx.split_once(F.concat("c_name", F.lit("#x")), "#")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.lower(tx.strip(F.concat(F.lit(" \t"), "c_name", F.lit("\n ")))).alias("stripped"),
        tx.strip_leading_zeros(F.split("c_name", "#")[1]).alias("no_zeros"),
        tx.capitalize("c_mktsegment").alias("capitalized"),
        tx.suffix("c_name", 8).alias("tail"),
        tx.prefix("c_name", 6).alias("head"),
        parts[0].alias("first_part"),
        parts[1].alias("second_part"),
        tx.zero_pad(F.col("c_nationkey").cast("string"), 2).alias("padded"),
    )


@query(
    "regex_contains",
    """
    SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(widget|bolt|anvil)', 'i')
    """,
)
def regex_contains(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return parts.filter(tx.contains_any("p_name", [w.upper() for w in PRODUCT_WORDS]))


@query(
    "regex_extract",
    """
    SELECT p_partkey,
           nullif(regexp_extract(p_name, '(widget|bolt|anvil)', 1), '') AS word,
           CASE WHEN p_name IN ('red bolt', 'old bolt') THEN 'BOLT PLUS'
                ELSE nullif(regexp_extract(p_name, '(widget|bolt|anvil)', 1), '') END AS product
    FROM part
    """,
)
def regex_extract(spark, folder):
    """First known word, with an override for texts in which a shorter word would win."""
    word = tx.extract_any("p_name", PRODUCT_WORDS)
    return table(spark, folder, "part").select(
        "p_partkey",
        word.alias("word"),
        F.when(F.col("p_name").isin("red bolt", "old bolt"), "BOLT PLUS").otherwise(word).alias("product"),
    )


@query(
    "parse_number",
    """
    SELECT o_orderkey, o_totalprice AS price, CAST(o_totalprice AS DECIMAL(18,2)) AS exact_price,
           round_even(o_totalprice / 100000, 2) AS scaled, CAST(NULL AS DOUBLE) AS bad
    FROM orders
    """,
)
def parse_number(spark, folder):
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.parse_number(text).alias("price"),
        numbers.parse_number(text, to=numbers.MONEY).alias("exact_price"),
        numbers.scale_and_round(numbers.parse_number(text), 100000).alias("scaled"),
        numbers.parse_number("o_orderpriority").alias("bad"),
    )


@query(
    "row_arithmetic",
    """
    SELECT o_orderkey, greatest(o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 200000.0 END) AS larger,
           abs(o_totalprice - 200000) AS distance, CAST(ceil(o_totalprice) AS BIGINT) AS up,
           coalesce(CASE WHEN o_orderstatus = 'F' THEN o_custkey END, 0) AS filled
    FROM orders
    """,
)
def row_arithmetic(spark, folder):
    final = F.col("o_orderstatus") == "F"
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.row_max("o_totalprice", F.when(final, F.lit(200000.0))).alias("larger"),
        F.abs(F.col("o_totalprice") - 200000).alias("distance"),
        F.ceil("o_totalprice").alias("up"),
        numbers.null_to_zero(F.when(final, F.col("o_custkey"))).alias("filled"),
    )


@query(
    "value_map",
    """
    WITH m(k, v) AS (VALUES ('1-URGENT', 'URG'), ('2-HIGH', 'HIG'), ('3-MEDIUM', 'MED'))
    SELECT o_orderkey, v AS mapped, coalesce(v, o_orderpriority) AS replaced,
           coalesce(v, o_orderstatus) AS mapped_or_status,
           CASE WHEN v IS NOT NULL THEN o_orderpriority END AS back
    FROM orders LEFT JOIN m ON o_orderpriority = k
    """,
)
def value_map(spark, folder):
    mapped = mapping.map_values("o_orderpriority", PRIORITY_CODES)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        mapped.alias("mapped"),
        mapping.replace_values("o_orderpriority", PRIORITY_CODES).alias("replaced"),
        mapping.map_or_else("o_orderpriority", PRIORITY_CODES, "o_orderstatus").alias("mapped_or_status"),
        mapping.map_values(mapped, mapping.inverted(PRIORITY_CODES)).alias("back"),
    )


@query(
    "bucket_other",
    """
    WITH e AS (SELECT CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN ''
                           ELSE event_type END AS kind FROM events)
    SELECT CASE WHEN kind IS NULL OR kind IN ('', 'error') THEN 'otros' ELSE kind END AS origin,
           count(*) AS events
    FROM e GROUP BY 1
    """,
)
def bucket_other(spark, folder):
    kind = mapping.replace_values("event_type", {"click": ""})
    kind = F.when(F.col("event_type") != "view", kind)
    return (
        table(spark, folder, "events")
        .select(mapping.bucket_other(kind, ["error"]).alias("origin"))
        .groupBy("origin")
        .agg(F.count("*").alias("events"))
    )


@query(
    "make_month",
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS from_parts,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS from_compact,
           strftime(o_orderdate, '%Y-%m-01') AS as_text,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS from_name,
           CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next_month
    FROM orders
    """,
)
def make_month(spark, folder):
    day = F.col("o_orderdate")
    year, month = F.year(day).cast("string"), F.month(day).cast("string")
    spanish = F.element_at(F.array(*[F.lit(n.upper()) for n in dates.SPANISH_MONTHS]), F.month(day))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.month_from_parts(year, month).alias("from_parts"),
        dates.month_from_compact(F.date_format(day, "yyyyMM")).alias("from_compact"),
        dates.month_text(year, month).alias("as_text"),
        dates.month_from_parts(year, dates.month_number(spanish)).alias("from_name"),
        dates.shift_months(dates.month_start(day), 1).alias("next_month"),
    )


@query(
    "calendar_features",
    """
    SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
           CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
    """,
)
def calendar_features(spark, folder):
    return (
        table(spark, folder, "orders")
        .withColumns(dates.calendar_columns("o_orderdate"))
        .select("o_orderkey", "quarter", "month", "year")
    )


@query(
    "json_field",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           CASE WHEN event_type = 'view' THEN '' ELSE json_extract_string(props, '$.k') END AS tooltip
    FROM events
    """,
)
def json_field(spark, folder):
    """A field of a JSON text; blank text gives blank."""
    tooltip = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("props"))
    return table(spark, folder, "events").select(
        "event_id",
        tx.json_text("props", "$.k").alias("k"),
        tx.json_text(tooltip, "$.k").alias("tooltip"),
    )
