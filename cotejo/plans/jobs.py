"""Whole runs: a shared base is stored once, its reports are written from there.

Each run has a number that grows from run to run. A run that is repeated under its number, after
a failure or by mistake, gives the same tables again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.functions.dates import run_stamp
from cotejo.functions.mapping import replace_values
from cotejo.operators.snapshots import LEDGER_SCHEMA, Origin, extend_ledger, snapshot_diff, snapshot_totals
from cotejo.plans.public_health import MEASURE, REGISTRY, indication_shares, registry_changes
from cotejo.plans.tenders import ORIGINS, chain_validation
from cotejo.session import cut_lineage
from cotejo.sources.delimited import write_delimited, write_outputs
from cotejo.sources.month_table import MonthTable

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DateType() if c == "Fecha" else T.LongType() if c == MEASURE else T.StringType())
        for c in REGISTRY
    ]
)


def run_history(
    tables: Mapping[str, tuple[DataFrame, DataFrame]],
    sites: DataFrame,
    frozen_sites: DataFrame,
    out: str,
    ledger: str,
    run: int,
    run_at: datetime,
    origins: Sequence[Origin] = ORIGINS,
    freeze: str | None = None,
) -> dict[str, str]:
    """Totals of live and frozen tables, their differences, and the ledger of all differences.

    The totals are stored once; both reports and the ledger read them from there. Of the ledger,
    a table in month partitions, only the months with differences are read and written.
    ``freeze`` names the newest freeze where it is known, from the partition folders.
    """
    totals = cut_lineage(
        reduce(
            DataFrame.unionByName,
            [snapshot_totals(*tables[o.name], sites, frozen_sites, o, freeze=freeze) for o in origins if o.name in tables],
        )
    )
    differences = cut_lineage(snapshot_diff(totals, run_stamp(run_at)))
    paths = write_outputs({"totals": totals, "differences": differences}, out)
    spark = totals.sparkSession
    table = MonthTable(spark, ledger, spark.createDataFrame([], LEDGER_SCHEMA).schema, "DATE")
    table.merge_months(differences, run, lambda old, new: extend_ledger(new, old))
    return {**paths, "ledger": ledger}


def run_chain(
    sources: Mapping[str, DataFrame],
    out: str,
    run_at: datetime,
    catalogue: DataFrame | None = None,
    encoding: str = "utf-16",
    **options,
) -> DataFrame:
    """The report of a chain of sources, written as text. Each source is read in two comparisons
    and is stored once before them; the report is stored before it is written."""
    stored = {name: cut_lineage(df) for name, df in sources.items()}
    report = cut_lineage(chain_validation(stored, run_at, catalogue, **options))
    write_delimited(report, out, ",", encoding)
    return report


def run_registry(
    latest: DataFrame,
    root: str,
    out: str,
    run: int,
    ingredients: Sequence[str],
    spellings: Mapping[str, str] | None = None,
    keep: int = 12,
) -> dict[str, str]:
    """Replace the last months of the registry by a download, and report what that changed in the
    months before and the shares of health problems.

    The registry is a table in month partitions: a run writes the months from the download's
    first date on, and the change report reads only the months that two versions hold
    differently. The ``keep`` newest versions stay, the folders of older ones are removed.
    """
    spark = latest.sparkSession
    table = MonthTable(spark, root, REGISTRY_SCHEMA, "Fecha")
    if spellings:
        latest = latest.withColumn("Principio activo", replace_values("Principio activo", dict(spellings)))
    latest = cut_lineage(latest.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA]))
    before = table.manifest(below=run)
    now = table.replace_window(latest, run)
    changed = {m for m in before | now if before.get(m) != now.get(m)}
    current, previous = (
        table.read({m: v for m, v in held.items() if m in changed}) for held in (now, before)
    )
    paths = write_outputs(
        {
            "changes": registry_changes(current, previous, ingredients),
            "shares": indication_shares(table.read(now), ingredients),
        },
        out,
    )
    table.remove_unused(keep)
    return {**paths, "registry": root}
