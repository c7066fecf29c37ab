"""Shares of a parent total, and distributing amounts by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotejo.functions.numbers import ratio
from cotejo.operators.aggregates import with_keys
from cotejo.operators.joins import lookup_join


def share_index(
    df: DataFrame,
    parent: str,
    child: str,
    measure: str,
    into: str = "Indice",
    exact: str | None = None,
    salts: int = 8,
) -> DataFrame:
    """Share of each child in the total of its parent.

    Sums of children and of parents come out of one aggregation over one scan (grouping sets).
    A parent's total is then repeated ``salts`` times and its children are dealt over these
    copies, where each finds the total as the first row of its group: no join, and a parent
    with very many children is spread over ``salts`` tasks.
    """
    amount = F.col(measure).cast(exact) if exact else F.col(measure)
    sums = (
        with_keys(df, [parent, child])
        .select(F.col(parent), F.col(child), amount.alias("__v"))
        .groupingSets([[F.col(parent), F.col(child)], [F.col(parent)]], F.col(parent), F.col(child))
        .agg(F.coalesce(F.sum("__v"), F.lit(0)).alias("__v"), F.grouping(child).alias("__is_total"))
    )
    copies = F.when(F.col("__is_total") == 1, F.sequence(F.lit(0), F.lit(salts - 1)))
    own = F.array(F.pmod(F.xxhash64(F.col(child)), F.lit(salts)).cast("int"))
    dealt = sums.withColumn("__salt", F.explode_outer(F.coalesce(copies, own)))
    group = Window.partitionBy(parent, "__salt").orderBy(F.desc("__is_total"))
    with_total = dealt.withColumn("__total", F.first("__v").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    return with_total.filter("__is_total = 0").select(parent, child, ratio("__v", "__total").alias(into))


def allocate_share(
    facts: DataFrame,
    shares: DataFrame,
    ratios: DataFrame,
    parent: str,
    child: str,
    product: str,
    quantity: str,
    index: str = "Indice",
    ratio_column: str = "Ratio",
    split: str = "Split",
    patients: str = "Pacientes Totales",
    digits: int | None = 2,
    salts: int = 1,
) -> DataFrame:
    """Distribute each quantity over the children of its parent, then convert by ratio.

    A fact row becomes one row per child. Without a ratio the result is null, which
    ``quality.unresolved_keys`` reports. ``digits`` None leaves the result unrounded.
    """
    fanned = lookup_join(facts, shares.select(parent, child, index), [parent], "left", salts)
    rated = lookup_join(
        fanned, ratios.select(parent, child, product, ratio_column), [parent, child, product], "left", salts
    )
    amount = F.col(quantity) * F.col(index)
    converted = ratio(amount, ratio_column)
    return rated.withColumns(
        {split: amount, patients: converted if digits is None else F.bround(converted, digits)}
    )
