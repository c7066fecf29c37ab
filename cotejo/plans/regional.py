"""Regional sales: the sales fact against the market, catalogue checks, forecast.

Inputs are the raw tables with their own column names; results are DataFrames. Facts are
summed per raw key before any dimension is joined, so that the joins and the text cleaning
see one row per key instead of one per sale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.dates import month_from_compact, run_stamp
from cotejo.functions.mapping import inverted, map_values, replace_values
from cotejo.functions.numbers import parse_number
from cotejo.functions.text import extract_any, strip, suffix, title_after_dash, title_case
from cotejo.operators import quality, reconcile, series
from cotejo.operators.aggregates import distinct_on, group_sum, with_keys
from cotejo.operators.filters import drop_totals
from cotejo.operators.joins import keep_known, lookup_join
from cotejo.operators.reshape import melt_sum

# Names and order of the comparison columns, scale of the sales amounts.
DIMENSIONS = ("Product", "Molecule", "Manufacturer", "Corporation", "Presentation")
HISTORY_KEYS = ("Date", *DIMENSIONS, "Country_ID", "Channel", "Metric")
SENT_KEYS = ("Date", "Product", "Country_ID", "Country_Name", "Channel")
SERIES = ("Metric", "Channel", "Country_ID", "Product")
AMOUNT_SCALE = 100000
STAMP = "Fecha extracción"
# Sums are made in this type, so that they don't depend on the order in which tasks end.
EXACT = "decimal(28,6)"


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("Value", F.col("Value").cast("double"))


def _titled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: title_case(c) for c in columns})


def product_dimension(
    products: DataFrame, manufacturers: DataFrame, molecules: DataFrame, countries: Sequence[str]
) -> DataFrame:
    """Product code and country -> the five descriptive columns; of several molecules of a
    product the first in order counts."""
    wanted = F.col("Country_ID").isin(*countries)
    described = products.join(manufacturers, ["COUNTRY_ABV_CD", "MANUFACTURER_CD"], "left").select(
        F.col("COUNTRY_ABV_CD").alias("Country_ID"),
        F.col("FCC_CD").cast("string").alias("Product_ID"),
        F.col("PRODUCT_DESC").alias("Product"),
        F.col("MANUFACTURER_DESC").alias("Manufacturer"),
        F.col("CORP_DESC").alias("Corporation"),
        F.col("PACK_DESC").alias("Presentation"),
    )
    single = distinct_on(
        molecules.select(
            F.col("COUNTRY_ABV_CD").alias("Country_ID"),
            F.col("FCC_CD").cast("string").alias("Product_ID"),
            F.col("MLCL_DESC").alias("Molecule"),
        ).filter(wanted),
        ["Country_ID", "Product_ID"],
    )
    joined = described.filter(wanted).join(single, ["Country_ID", "Product_ID"], "left")
    return _titled(joined, DIMENSIONS)


def sales_fact(
    sales: DataFrame, dimension: DataFrame, countries: Sequence[str], dims: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Long sales fact: month, dimensions, country, channel, metric (QTY, USD), ``Value``."""
    amount = F.bround(parse_number("LIST_VALUES_USD_AMT", ",") / AMOUNT_SCALE, 2)
    rows = sales.filter(F.col("COUNTRY_ABV_CD").isin(*countries)).select(
        month_from_compact("PERIOD_CD").alias("Date"),
        F.col("COUNTRY_ABV_CD").alias("Country_ID"),
        F.col("CHANNEL_DESC").alias("Channel"),
        F.col("FCC_CD").cast("string").alias("Product_ID"),
        F.col("UNITS_QTY").cast("double").alias("QTY"),
        amount.alias("USD"),
    )
    summed = group_sum(
        with_keys(rows, ["Date"]), ["Date", "Country_ID", "Channel", "Product_ID"], ["QTY", "USD"], EXACT, keep_nulls=True
    )
    described = lookup_join(
        summed, dimension.select("Country_ID", "Product_ID", *dims), ["Country_ID", "Product_ID"]
    )
    keys = ["Date", *dims, "Country_ID", "Channel"]
    return _plain(melt_sum(_titled(described, ["Channel"]), keys, ["QTY", "USD"], exact=EXACT, keep_nulls=True))


def market_fact(market: DataFrame, country_codes: Mapping[str, str]) -> DataFrame:
    """Long market fact with the same columns. The total row is known by its period."""
    rows = drop_totals(market, "Period").select(
        month_from_compact(F.col("Period").cast("string")).alias("Date"),
        F.col("Product Description2").alias("Product"),
        "Molecule",
        F.col("Manufacturer Description").alias("Manufacturer"),
        F.col("Corporation Description").alias("Corporation"),
        F.col("Pack Description").alias("Presentation"),
        replace_values(F.col("Country Code").cast("string"), country_codes).alias("Country_ID"),
        "Channel",
        F.col("Units").cast("double").alias("QTY"),
        F.bround(F.col("Values Usd").cast("double"), 2).alias("USD"),
    )
    raw = ["Date", *DIMENSIONS, "Country_ID", "Channel"]
    summed = group_sum(with_keys(rows, ["Date"]), raw, ["QTY", "USD"], EXACT, keep_nulls=True)
    return _plain(melt_sum(_titled(summed, [*DIMENSIONS, "Channel"]), raw, ["QTY", "USD"], exact=EXACT, keep_nulls=True))


def historical_validation(
    fact: DataFrame, market: DataFrame, run_at: datetime, left: str = "FF Value", right: str = "Market Value"
) -> DataFrame:
    """Sales fact against market, one row per key of either."""
    names = reconcile.Names(left=left, right=right)
    return reconcile.reconcile(fact, market, HISTORY_KEYS, "abs", names=names).withColumn(
        STAMP, run_stamp(run_at)
    )


def dimension_reports(fact: DataFrame, groups: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Appearing and disappearing members for several groups of columns. The fact feeds every
    report; pass it through ``session.cut_lineage`` first when it is expensive."""
    return {name: quality.period_membership(fact, columns) for name, columns in groups.items()}


def catalogue_reports(
    market: DataFrame,
    dimensional: DataFrame,
    catalogue: DataFrame,
    labels: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """The four catalogue checks: class codes of catalogue and of the dimensional report
    against the market, products with several molecules, molecules against the market."""
    labels = labels or {}
    flex = drop_totals(market, "Period", null_is_total=True).select(
        title_case(strip("Product Description2")).alias("Product"),
        title_case(strip("Product Description")).alias("Product v2"),
        title_case(strip("Molecule")).alias("Molecule"),
        title_case("Pack Description").alias("Presentation"),
        title_after_dash("Atc 4").alias("ATC IV"),
    )
    dim = dimensional.select(
        title_case("MOLECULE").alias("Molecule"),
        title_case("PACK_DESC").alias("Presentation"),
        title_after_dash("ATC4").alias("ATC IV"),
    )
    classes = catalogue.withColumnsRenamed({"OVERALL TA ": "Overall TA", "HS/OTHER": "Category"})
    classes = _titled(classes, ["Overall TA", "Category"]).withColumn("ATC IV", title_after_dash("ATC IV"))
    return {
        "class_market": quality.membership_by_key(
            classes.select("ATC IV", "Overall TA", "Category"),
            flex.select("ATC IV"),
            ["ATC IV"],
            labels.get("class_market", {}),
        ),
        "class_dimension": quality.membership_by_row(
            dim.select("ATC IV", "Presentation"),
            flex.select("ATC IV"),
            ["ATC IV"],
            labels.get("class_dimension", {}),
        ),
        "double_molecules": quality.multi_parent_check(flex, "Product v2", "Molecule"),
        "molecule_dimension": quality.membership_by_row(
            flex.select("Molecule", "Product", "Presentation", "ATC IV"),
            dim.select("Molecule"),
            ["Molecule"],
            labels.get("molecule_dimension", {}),
            detailed_is_left=False,
        ),
    }


def relevant_products(
    products: DataFrame, brands: Sequence[str], overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Product code -> brand found in the description; ``overrides`` gives the brand of whole
    descriptions in which a shorter brand name would be found first."""
    found = extract_any("SKU Description", brands)
    named = products.select(
        F.col("Product Internal Code").cast("string").alias("Product_ID"),
        found.alias("found"),
        (map_values("SKU Description", overrides) if overrides else F.lit(None).cast("string")).alias("given"),
    ).dropna(subset=["found"])
    return named.select("Product_ID", title_case(F.coalesce("given", "found")).alias("Product"))


def client_countries(
    clients: DataFrame, codes: Mapping[str, str], corrections: Mapping[str, str]
) -> DataFrame:
    """Client code (its last eight characters) -> country code."""
    country = replace_values(title_case(strip("Country")), corrections)
    return clients.select(
        suffix(F.col("Client Internal Code").cast("string"), 8).alias("Client Internal Code"),
        map_values(country, codes).alias("Country_ID"),
    )


def sent_fact(
    sent: DataFrame,
    products: DataFrame,
    clients: DataFrame,
    codes: Mapping[str, str],
    channels: Mapping[str, str],
) -> DataFrame:
    """Units sent per month, product, country and channel. ``sent`` has a date column
    ``Date`` (see ``sources.delimited.unify_dates``)."""
    rows = sent.select(
        F.trunc("Date", "MM").alias("Date"),
        F.col("Product Internal Code").cast("string").alias("Product_ID"),
        suffix(F.col("Client Internal Code").cast("string"), 8).alias("Client Internal Code"),
        F.col("Market Type / Outlet Canal").alias("Channel"),
        F.col("Units of SKU").cast("long").alias("Value"),
    )
    known = keep_known(rows, products, ["Product_ID"])
    summed = group_sum(known, ["Date", "Product_ID", "Client Internal Code", "Channel"], ["Value"], EXACT)
    placed = lookup_join(summed, clients, ["Client Internal Code"])
    named = lookup_join(placed, products, ["Product_ID"]).withColumns(
        {
            "Country_Name": map_values("Country_ID", inverted(codes)),
            "Channel": replace_values(strip("Channel"), channels),
        }
    )
    return _plain(group_sum(named, SENT_KEYS, ["Value"], EXACT))


def market_units(market: DataFrame, manufacturer: str, codes: Mapping[str, str]) -> DataFrame:
    """Units of one manufacturer per month, product, country and channel."""
    rows = drop_totals(market, "Period").filter(F.col("Manufacturer Description") == manufacturer).select(
        month_from_compact(F.col("Period").cast("string")).alias("Date"),
        title_case("Product Description2").alias("Product"),
        F.col("Country Code").alias("Country_ID"),
        map_values("Country Code", inverted(codes)).alias("Country_Name"),
        title_case("Channel").alias("Channel"),
        F.col("Units").alias("Value"),
    )
    return _plain(group_sum(rows, SENT_KEYS, ["Value"], EXACT))


def sent_vs_market(
    sent: DataFrame, market: DataFrame, run_at: datetime, left: str = "Sent Units", right: str = "Market Units"
) -> DataFrame:
    """Sent units against market units, with signed differences."""
    names = reconcile.Names(left=left, right=right)
    return reconcile.reconcile(sent, market, SENT_KEYS, "signed", names=names).withColumn(
        STAMP, run_stamp(run_at)
    )


def outliers_and_forecast(fact: DataFrame, horizon: int = 3, until: Column | None = None) -> DataFrame:
    """Holdout prediction, outlier flag and forecast of every series of the sales fact."""
    return series.forecast(fact, SERIES, horizon=horizon, until=until)


