"""Public health: registry master refresh, its retroactive differences and shares, and the
patients behind public purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.dates import month_from_parts, month_number
from cotejo.functions.mapping import bucket_other, replace_values
from cotejo.functions.numbers import parse_number
from cotejo.functions.text import capitalize, contains_any, extract_any, split_once, strip, title_case
from cotejo.operators import quality, refresh, shares
from cotejo.operators.aggregates import with_keys
from cotejo.operators.dashboard import decode_worksheet
from cotejo.operators.filters import drop_totals
from cotejo.operators.joins import dict_lookup

# Columns of the registry and their names in the download.
REGISTRY = (
    "Fecha", "Principio activo", "Problema de salud", "Estado",
    "Región de Origen", "Establecimiento Origen", "Número de registros",
)
DOWNLOAD_NAMES = {
    "Establecimiento Origen-alias": "Establecimiento Origen",
    "Problema de salud-alias": "Problema de salud",
    "Región de Origen-alias": "Región de Origen",
    "Principio Activo": "Principio activo",
    "SUM(Number of Records)-alias": "Número de registros",
}
MEASURE = "Número de registros"
# Origins that are put together.
RARE_ORIGINS = ("traspaso", "fonasa", "minsal")


def registry_from_payloads(
    payloads: DataFrame, worksheet: str, payload: str = "payload", info: str | None = None
) -> DataFrame:
    """Download rows out of stored dashboard payloads.

    ``payloads`` has one row per payload with its ``Principio Activo``, ``Estado`` and
    ``period`` ("month year"); total rows of the dashboard are dropped.
    """
    names = [n for n in DOWNLOAD_NAMES if n.endswith("-alias")]
    period = split_once("period", " ")
    ids = ["Principio Activo", "Estado", "Mes", "Año"]
    described = payloads.withColumns({"Mes": capitalize(period[0]), "Año": period[1]})
    decoded = decode_worksheet(described, ids, payload, worksheet, names, info=info)
    kept = drop_totals(drop_totals(decoded, "Establecimiento Origen-alias"), "Problema de salud-alias")
    measure = "SUM(Number of Records)-alias"
    return kept.drop("row_no").withColumn(measure, parse_number(measure, ",", "bigint"))


def registry_download(df: DataFrame) -> DataFrame:
    """The last download with the columns of the master; months are given by name."""
    dated = df.withColumn("Fecha", month_from_parts("Año", month_number("Mes")))
    return dated.withColumnsRenamed(DOWNLOAD_NAMES).select(*[F.col(f"`{c}`") for c in REGISTRY])


def refreshed_registry(master: DataFrame, latest: DataFrame, spellings: dict[str, str] | None = None) -> DataFrame:
    """Master with its last months replaced by the download; spellings are unified."""
    merged = refresh.window_refresh(master, latest)
    return merged.withColumn("Principio activo", replace_values("Principio activo", spellings or {})) if spellings else merged


def registry_changes(current: DataFrame, previous: DataFrame, ingredients: Sequence[str]) -> DataFrame:
    """Keys whose record count changed between two versions, for some ingredients. The filter
    is on a key, so it is applied to both versions before they are summed."""
    wanted = F.col("Principio activo").isin(*ingredients)
    return refresh.retro_diff(current.filter(wanted), previous.filter(wanted), REGISTRY[:-1], MEASURE)


def indication_shares(registry: DataFrame, ingredients: Sequence[str]) -> DataFrame:
    """Share of each health problem in the records of its ingredient. Rows with a missing key
    are no part of the grouped registry and do not count."""
    grouped = with_keys(registry, REGISTRY[:-1])
    wanted = grouped.filter(F.col("Principio activo").isin(*ingredients))
    return shares.share_index(wanted, "Principio activo", "Problema de salud", MEASURE)


def _purchases(
    df: DataFrame, ingredients: Sequence[str], name: str, year: str, month: str, where: Column | None
) -> DataFrame:
    kept = df if where is None else df.filter(where)
    return kept.filter(contains_any(name, ingredients)).withColumns(
        {
            "Fecha": month_from_parts(year, F.col(f"`{month}`").try_cast("double").cast("int")),
            "Principio activo": title_case(extract_any(name, ingredients, ignore_case=True)),
        }
    )


def _with_sites(df: DataFrame, recipient: str, sites: DataFrame, salts: int) -> DataFrame:
    lowered = df.withColumn(recipient, F.lower(recipient))
    return dict_lookup(lowered, recipient, sites, "CENABAST", "FONASA", "Establecimiento destino", salts=salts)


def purchases_v1(
    purchases: DataFrame,
    index: DataFrame,
    ratios: DataFrame,
    sites: DataFrame,
    regions: DataFrame,
    ingredients: Sequence[str],
    salts: int = 1,
) -> dict[str, DataFrame]:
    """Patients per purchase, with region and origin, and the keys nobody could resolve.
    ``salts`` spreads the purchases of a hot ingredient, site or town over several tasks."""
    rows = _purchases(purchases, ingredients, "NombreGenerico", "anio", "Mes", None)
    origin = bucket_other(strip(F.lower("Origen")), RARE_ORIGINS)
    rows = rows.withColumns(
        {"Origen": title_case(origin), "ComunaDestinatario": F.lower("ComunaDestinatario")}
    )
    placed = _with_sites(rows, "NombreDestinatario", sites, salts)
    placed = dict_lookup(placed, "ComunaDestinatario", regions, "Comuna", "Region", "Region", salts=salts)
    allocated = shares.allocate_share(
        placed, index, ratios, "Principio activo", "Problema de salud", "Denominacion", "CantidadDespacho",
        salts=salts,
    )
    result = allocated.select(
        "Fecha", "Principio activo", "Problema de salud", "Region", "Establecimiento destino",
        "Pacientes Totales", "Origen",
    )
    return {
        "patients": result,
        # Sites do not depend on the shares; ratios are open per product after the rows fan out.
        "open_sites": quality.unresolved_keys(placed, "Establecimiento destino", ["NombreDestinatario"]),
        "open_ratios": quality.unresolved_keys(allocated, "Ratio", ["Denominacion"]),
    }


def purchases_v2(
    purchases: DataFrame,
    index: DataFrame,
    ratios: DataFrame,
    sites: DataFrame,
    ingredients: Sequence[str],
    channel: str = "Ley Ricarte Soto",
    salts: int = 1,
) -> dict[str, DataFrame]:
    """The same for the later layout: one channel only, unrounded, ratios per trade name."""
    product, recipient = "Nombre producto comercial", "Nombre cliente destinatario"
    rows = _purchases(
        purchases, ingredients, "Nombre producto genérico", "Año", "Mes",
        F.col("Nombre canal de distribución") == channel,
    )
    placed = _with_sites(rows, recipient, sites, salts)
    allocated = shares.allocate_share(
        placed, index, ratios, "Principio activo", "Problema de salud", product, "Cantidad de pedido", digits=None,
        salts=salts,
    )
    result = allocated.select(
        "Fecha", "Principio activo", "Problema de salud", "Nombre región", "Establecimiento destino",
        "Pacientes Totales",
    )
    return {
        "patients": result,
        "open_sites": quality.unresolved_keys(placed, "Establecimiento destino", [recipient]),
        "open_ratios": quality.unresolved_keys(
            allocated, "Ratio", ["Principio activo", "Problema de salud", product]
        ),
    }
