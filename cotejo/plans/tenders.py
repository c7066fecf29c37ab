"""Public tenders: four sources of deliveries, consumption and awards in a chain, the totals
of live and frozen lake tables, and the consolidated report.

Every source becomes the same long fact (Date, Institucion, product, Metric, Value) by a
``SourceSpec``; the jobs below then only compare.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.functions.dates import month_from_parts, month_number, run_stamp
from cotejo.functions.mapping import map_or_else
from cotejo.functions.numbers import LAKE_DECIMAL, parse_number
from cotejo.functions.text import strip_leading_zeros, title_case
from cotejo.operators import reconcile
from cotejo.operators.aggregates import group_sum
from cotejo.operators.clean import SourceSpec, clean_source
from cotejo.operators.joins import lookup_join
from cotejo.operators.reshape import crosstab_to_long
from cotejo.operators.snapshots import LEDGER_SCHEMA, Origin, diff_ledger, snapshot_diff, snapshot_totals
from cotejo.sources.delimited import read_or_empty

# The placeholder product and its name, the report columns.
NO_PRODUCT = "-1"
NO_PRODUCT_NAME = "Sin Identificar"
STAMP = "Fecha extracción"
REPORT = ("Date", "Institucion", "Product", "Metric", "Value_x", "Value_y",
          "Comparativa", "Diff Abs", "Diff %", "Motivo", STAMP)

# The seven table pairs of the lake. Measure column -> name in the report.
_SITE = "clave_clues"
ORIGINS = (
    Origin("ALTAS NORMALES", {"piezas": "PIEZAS", "importe": "IMPORTE", "precio": "PRECIO"}, _SITE, "marca"),
    Origin("ALTAS IMSS", {"piezas_alta_imss": "PIEZAS", "importe": "IMPORTE", "precio": "PRECIO"}, "clues", "marca"),
    Origin("ALTAS ISSSTE", {"piezas": "PIEZAS", "importe": "IMPORTE", "precio": "PRECIO"}, _SITE, None),
    Origin("FALLOS", {"piezas": "PIEZAS", "importe_max": "IMPORTE", "precio": "PRECIO"}, _SITE, "marca_requerida"),
    Origin(
        "CONSUMOS IMSS",
        {"inventario": "INVENTARIO", "cpm_r": "CPM R", "cpm_v": "CPM V", "piezas_alta": "PIEZAS"},
        _SITE, None,
    ),
    Origin(
        "CONSUMOS ISSSTE",
        {"inventario": "INVENTARIO", "consumo_autorizado": "CONSUMO AUTORIZADO", "dpn": "DPN", "piezas_alta": "PIEZAS"},
        _SITE, None,
    ),
    Origin(
        "CONSUMOS CENSIDA",
        {"inventario": "INVENTARIO", "consumo_autorizado": "CONSUMO AUTORIZADO",
         "numero_pacientes": "NUMERO PACIENTES", "altas": "PIEZAS"},
        _SITE, None,
    ),
)


@dataclass(frozen=True)
class FlatFile:
    """One institution's file: the measure columns and how many years it keeps."""

    institution: str
    measures: Mapping[str, str]
    back: int | None = 2


def flat_fact(df: DataFrame, file: FlatFile, product: str = "CLAVE_CByCM", exact: str | None = LAKE_DECIMAL) -> DataFrame:
    """Deliveries, consumption or awards of one institution out of its flat file."""
    spec = SourceSpec(
        rename={product: "Product_ID", **{column: name for column, name in file.measures.items()}},
        derive={"Date": month_from_parts("ANNUAL", "MES")},
        literals={"Institucion": file.institution},
        back=file.back,
        keys=["Date", "Institucion", "Product_ID"],
        measures=list(dict.fromkeys(file.measures.values())),
        exact=exact,
    )
    return clean_source(df, spec)


def flat_facts(files: Sequence[tuple[DataFrame, FlatFile]], exact: str | None = LAKE_DECIMAL) -> DataFrame:
    return reduce(DataFrame.unionByName, [flat_fact(df, file, exact=exact) for df, file in files])


def award_flat_fact(
    df: DataFrame, institutions: DataFrame, wanted: Sequence[str], back: int = 2, exact: str | None = LAKE_DECIMAL
) -> DataFrame:
    """Awards: the institution comes from the site, and only some institutions count. Sums per
    site come first, the site is looked up for them."""
    per_site = group_sum(
        df, ["ANNUAL", "MES", "CLAVE_CLUES", "CLAVE_CByCM"], ["PIEZAS", "IMPORTE_MAX"], exact
    )
    placed = lookup_join(
        per_site,
        institutions.select("CLAVE_CLUES", F.col("INSTITUCION").alias("Institucion")),
        ["CLAVE_CLUES"],
    )
    spec = SourceSpec(
        rename={"CLAVE_CByCM": "Product_ID", "PIEZAS": "Units", "IMPORTE_MAX": "MXN"},
        derive={"Date": month_from_parts("ANNUAL", "MES")},
        where=F.col("Institucion").isin(*wanted),
        back=back,
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Units", "MXN"],
        exact=exact,
    )
    return clean_source(placed, spec)


def award_dashboard_fact(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Awards out of the dashboard export: month names and numbers with separators."""
    spec = SourceSpec(
        rename={"INSTITUCIÓN": "Institucion", "CLAVE CNIS_anterior": "Product_ID"},
        derive={
            "Units": parse_number("PIEZAS", ",", LAKE_DECIMAL),
            "MXN": parse_number("IMPORTE", to=LAKE_DECIMAL),
            "Date": month_from_parts("AÑO", month_number(F.trim("`MES `"))),
        },
        where=F.col("Institucion").isin(*wanted),
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Units", "MXN"],
    )
    return clean_source(df, spec)


def delivery_lake_fact(lake: DataFrame) -> DataFrame:
    """Result of the stored deliveries statement as long fact."""
    spec = SourceSpec(
        rename={"institucion": "Institucion", "product_id": "Product_ID", "units": "Units", "amount": "MXN"},
        derive={"Date": F.to_date("month_date")},
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Units", "MXN"],
        exact=LAKE_DECIMAL,
    )
    return clean_source(lake, spec)


def delivery_export_fact(
    df: DataFrame,
    regular: str,
    programme: str,
    programme_institutions: Sequence[str] = ("IMSS", "ISSSTE"),
    regular_institution: str = "Normales",
) -> DataFrame:
    """Deliveries out of the BI export: two sub channels, one of them for some institutions."""
    channel = F.col("Sub Channel")
    spec = SourceSpec(
        rename={"Institution": "Institucion", "CByCM": "Product_ID"},
        derive={
            "Date": F.trunc(F.col("Date").cast("date"), "MM"),
            "Product_ID": strip_leading_zeros("Product_ID"),
            "__kept": (channel == regular)
            | ((channel == programme) & F.col("Institucion").isin(*programme_institutions)),
            "Institucion": F.when(channel == regular, regular_institution).otherwise(F.col("Institucion")),
        },
        where=F.col("__kept"),
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Units", "MXN"],
        exact=LAKE_DECIMAL,
    )
    return clean_source(df, spec)


def consumption_lake_fact(lake: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Result of the stored consumption statement as long fact. ``metrics`` names the
    consumption measure of each institution; the stock keeps its own name."""
    spec = SourceSpec(
        rename={"institucion": "Institucion", "product_id": "Product_ID", "stock": "Inventario"},
        derive={"Date": F.to_date("month_date")},
        keys=["Date", "Institucion", "Product_ID"],
        measures=["Inventario", "consumption"],
        exact=LAKE_DECIMAL,
    )
    metric = F.when(F.col("Metric") == "consumption", map_or_else("Institucion", metrics, "Metric"))
    return clean_source(lake, spec).withColumn("Metric", F.coalesce(metric, F.col("Metric")))


def by_product_name(fact: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Fact per product name instead of product code, for sources that only know names.
    Codes with the same name are summed; codes without a name are left out."""
    keys = ["Date", "Institucion", "Product", "Metric"]
    exact = None if isinstance(fact.schema["Value"].dataType, T.DecimalType) else LAKE_DECIMAL
    return group_sum(add_products(fact, catalogue), keys, ["Value"], exact)


def consumption_export_fact(
    measures: DataFrame, stock: DataFrame, institution: str, column: str, metric: str, back: int = 4
) -> DataFrame:
    """Consumption out of two BI exports, one with the stock and one with the other measure.
    The two are stacked, each with nulls for the other's measure: the sums bring them together
    and a join is not needed."""
    both = measures.unionByName(stock, allowMissingColumns=True)
    spec = SourceSpec(
        rename={"Stock": "Inventario", column: metric},
        derive={
            "Date": F.trunc(F.col("Month").cast("date"), "MM"),
            "Product": title_case("Molecule"),
        },
        literals={"Institucion": institution},
        back=back,
        keys=["Date", "Institucion", "Product"],
        measures=["Inventario", metric],
        exact=LAKE_DECIMAL,
    )
    return clean_source(both, spec)


def crosstab_fact(
    sheets: DataFrame, rows: str, institution: str, measures: Mapping[str, str], product: str = "Product_ID",
    placeholder: str = NO_PRODUCT, drop_columns: int = 0,
) -> DataFrame:
    """A dashboard crosstab as long fact with a placeholder product."""
    long = crosstab_to_long(sheets, [], rows, measures, drop_columns)
    spec_keys = ["Date", "Institucion", product, "Metric"]
    placed = long.withColumns({"Institucion": F.lit(institution), product: F.lit(placeholder)})
    return placed.groupBy(*spec_keys).agg(F.coalesce(F.sum(F.col("Value").cast(LAKE_DECIMAL)), F.lit(0)).alias("Value"))


def add_products(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Name of the product; the placeholder product is named as such."""
    names = catalogue.select(
        F.col("CLAVE_CBYCM").cast("string").alias("Product_ID"), title_case("PRINC_ACTIVO").alias("Product")
    )
    named = lookup_join(df, names, ["Product_ID"])
    return named.withColumn(
        "Product", F.when(F.col("Product_ID") == NO_PRODUCT, NO_PRODUCT_NAME).otherwise(F.col("Product"))
    )


def chain_validation(
    sources: Mapping[str, DataFrame],
    run_at: datetime,
    catalogue: DataFrame | None = None,
    product: str = "Product_ID",
    coarse_first: bool = False,
) -> DataFrame:
    """The report of a chain of sources, each compared with the next.

    With ``coarse_first`` the first source has no products: its comparison is made at month,
    institution and metric, and the second source is summed to that.
    """
    names = list(sources)
    keys = ["Date", "Institucion", product, "Metric"]
    pairs = list(zip(names, names[1:]))
    if coarse_first:
        first, second = pairs.pop(0)
        rolled = reconcile.reconcile_rollup(
            sources[first], sources[second], ["Date", "Institucion", "Metric"], carry=[product]
        ).withColumn("Comparativa", F.lit(f"{first} vs {second}"))
        rest = {n: sources[n] for n in names[1:]}
        report = reconcile.reconcile_chain(rest, keys, pairs).unionByName(rolled)
    else:
        report = reconcile.reconcile_chain(sources, keys)
    if catalogue is not None:
        report = add_products(report, catalogue)
    return report.withColumn(STAMP, run_stamp(run_at)).select(*[F.col(f"`{c}`") for c in REPORT])


def consolidated(reports: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports in one table with their name, and its rows that show a difference."""
    unified = reconcile.labelled_union(reports, "Validation")
    return {"unified": unified, "differences": reconcile.keep_differences(unified)}


def snapshot_history(
    tables: Mapping[str, tuple[DataFrame, DataFrame]],
    sites: DataFrame,
    frozen_sites: DataFrame,
    ledger_path: str,
    run_at: datetime,
    origins: Sequence[Origin] = ORIGINS,
) -> dict[str, DataFrame]:
    """Totals, differences and the ledger with the new differences added.

    ``tables`` gives the live and the frozen table per origin name. The ledger is read from
    ``ledger_path``; write the result elsewhere, or after ``session.cut_lineage``.
    """
    totals = reduce(
        DataFrame.unionByName,
        [snapshot_totals(*tables[o.name], sites, frozen_sites, o) for o in origins if o.name in tables],
    )
    differences = snapshot_diff(totals, run_stamp(run_at))
    ledger = read_or_empty(totals.sparkSession, ledger_path, LEDGER_SCHEMA)
    return {"totals": totals, "differences": differences, "ledger": diff_ledger(differences, ledger)}
