"""Live data against its newest freeze, and the ledger of differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.dates import month_from_parts
from cotejo.functions.numbers import LAKE_DECIMAL, ratio
from cotejo.operators.aggregates import distinct_on, with_keys
from cotejo.operators.joins import lookup_join
from cotejo.operators.reconcile import Labels

# Columns of the totals table, and the key of a ledger entry.
TOTALS_INDEX = ("DATE", "ORIGEN", "INSTITUCION", "MARCA", "VARIABLE")
LEDGER_KEY = (
    "DATE", "ORIGEN", "INSTITUCION", "VARIABLE",
    "TOTAL_STANDARD", "TOTAL_FREEZE", "DIFF ABS", "DIFF%",
)
LEDGER_SCHEMA = (
    "`DATE` date, `ORIGEN` string, `INSTITUCION` string, `MARCA` string, `VARIABLE` string, "
    "`TOTAL_STANDARD` double, `TOTAL_FREEZE` double, `DIFF ABS` double, `DIFF%` double, "
    "`MOTIVO` string, `FECHA IDENTIFICACION` string"
)


@dataclass(frozen=True)
class Origin:
    """What differs between the live/frozen table pairs."""

    name: str
    measures: Mapping[str, str]
    site: str = "clues"
    brand: str | None = "marca"


def newest_slice(df: DataFrame, snapshot: str = "ref_frz_dt", freeze: str | None = None) -> DataFrame:
    """Rows of the newest freeze. On a table partitioned by ``snapshot`` the scalar bound
    prunes the other partitions; a ``freeze`` that is known does so when the plan is made, and
    saves the search for the newest one."""
    if freeze is not None:
        return df.filter(F.col(snapshot) == F.lit(freeze).cast(df.schema[snapshot].dataType))
    return df.filter(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


def snapshot_totals(
    live: DataFrame,
    frozen: DataFrame,
    sites: DataFrame,
    frozen_sites: DataFrame,
    origin: Origin,
    site_key: str = "clave_clues",
    institution: str = "institucion",
    snapshot: str = "ref_frz_dt",
    salts: int = 1,
    freeze: str | None = None,
) -> DataFrame:
    """Totals of a live table and of its newest freeze (or of ``freeze``), side by side.

    One row per month, institution, brand and measure; ``DATE_STANDARD`` is the newest live
    month, ``DATE_FREEZE`` the newest freeze date, null where that side has no rows. Each side
    is summed per site before the sites are looked up; the sums are stacked and summed in one
    aggregation, and only its result is turned into rows per measure.
    """
    month = month_from_parts("annual", "mes")
    newest_month = live.select("annual", "mes").distinct().agg(F.max(month)).scalar()
    newest_freeze = frozen.agg(F.max(snapshot)).scalar() if freeze is None else F.lit(freeze).cast(frozen.schema[snapshot].dataType)

    def side(df: DataFrame, dim: DataFrame, is_live: bool) -> DataFrame:
        """Sums per month, site and brand. Months stay text and sites are looked up only for
        the sums, not for the rows."""
        brand = F.lit("-") if origin.brand is None else F.col(origin.brand)
        summed = df.groupBy(
            "annual", "mes", F.col(origin.site).alias(site_key), brand.alias("MARCA")
        ).agg(*[F.sum(F.col(m).try_cast(LAKE_DECIMAL)).alias(m) for m in origin.measures])
        known = lookup_join(summed, dim.select(site_key, institution), [site_key], "left", salts)
        return known.select(
            month.alias("DATE"),
            F.col(institution).alias("INSTITUCION"),
            "MARCA",
            F.lit(is_live).alias("__live"),
            *origin.measures,
        )

    stacked = side(live, sites, True).unionByName(
        side(newest_slice(frozen, snapshot, freeze), newest_slice(frozen_sites, snapshot, freeze), False)
    )
    is_live = F.col("__live")

    def total(measure: str, condition: Column) -> Column:
        return F.bround(F.sum(F.when(condition, F.coalesce(F.col(measure), F.lit(0)))), 2)

    grouped = (
        with_keys(stacked, ["DATE", "INSTITUCION", "MARCA"])
        .groupBy("DATE", "INSTITUCION", "MARCA")
        .agg(
            F.bool_or(is_live).alias("__has_live"),
            F.bool_or(~is_live).alias("__has_frozen"),
            *[
                F.struct(
                    F.lit(label).alias("VARIABLE"),
                    total(measure, is_live).cast("double").alias("TOTAL_STANDARD"),
                    total(measure, ~is_live).cast("double").alias("TOTAL_FREEZE"),
                ).alias(f"__m{i}")
                for i, (measure, label) in enumerate(origin.measures.items())
            ],
        )
    )
    rows = F.array(*[F.col(f"__m{i}") for i in range(len(origin.measures))])
    return grouped.select(
        "DATE",
        F.lit(origin.name).alias("ORIGEN"),
        "INSTITUCION",
        "MARCA",
        F.when(F.col("__has_live"), newest_month).alias("DATE_STANDARD"),
        F.when(F.col("__has_frozen"), newest_freeze).alias("DATE_FREEZE"),
        F.inline(rows),
    ).select(*TOTALS_INDEX, "DATE_STANDARD", "DATE_FREEZE", "TOTAL_STANDARD", "TOTAL_FREEZE")


def snapshot_diff(totals: DataFrame, run_stamp: Column | None = None, labels: Labels = Labels()) -> DataFrame:
    """Differences of the totals. Equal totals are dropped; a difference that is null because
    a side is missing stays. A zero live total has no relative difference."""
    live, frozen = F.col("TOTAL_STANDARD"), F.col("TOTAL_FREEZE")
    difference = F.bround(F.abs(live - frozen), 2)
    stamp = [run_stamp.alias("FECHA IDENTIFICACION")] if run_stamp is not None else []
    return totals.select(
        *TOTALS_INDEX,
        "TOTAL_STANDARD",
        "TOTAL_FREEZE",
        difference.alias("DIFF ABS"),
        F.bround(ratio(frozen, live) - 1, 10).alias("DIFF%"),
        F.when(live.isNull() | frozen.isNull(), labels.missing).otherwise(labels.unknown).alias("MOTIVO"),
        *stamp,
    ).filter(~F.col("DIFF ABS").eqNullSafe(F.lit(0.0)))


def diff_ledger(new: DataFrame, old: DataFrame, keys: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """All differences ever found, each once; when a known one is found again the new row
    stays. Nulls in the key match each other."""
    aged = new.withColumn("__old", F.lit(False)).unionByName(old.withColumn("__old", F.lit(True)))
    return distinct_on(aged, list(keys), ["__old"]).drop("__old")


def extend_ledger(new: DataFrame, ledger: DataFrame, keys: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """``diff_ledger`` for a ledger, in which each key stands once already.

    The new differences are reduced among themselves, and old rows pass unless they are found
    again: one anti join, in which the planner broadcasts the new keys as long as they are
    small, so that the ledger is neither shuffled nor sorted. Nulls in the key match each other.
    """
    found = distinct_on(new, list(keys)).select(*ledger.columns)
    old, again = ledger.alias("__old"), found.alias("__new")
    same = reduce(and_, [F.col(f"__old.`{k}`").eqNullSafe(F.col(f"__new.`{k}`")) for k in keys])
    return old.join(again, same, "left_anti").unionByName(found)
