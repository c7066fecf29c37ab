"""Comparing two or more long facts.

A full outer join of two grouped facts needs two shuffles and two sorts, and a join cannot
split a hot key of a full outer side. Here the sides are tagged and stacked, and one grouped
aggregation gives every side's sum next to the others: one shuffle for any number of sources,
partial sums before it, and null keys that match each other. A side that has no row for a key
gives null, a side whose values are all null gives 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.functions.numbers import ratio


@dataclass(frozen=True)
class Labels:
    """Texts of the reason column."""

    missing: str = "Un origen no tiene información"
    equal: str = "Sin diferencias"
    unknown: str = "Sin identificar"


@dataclass(frozen=True)
class Names:
    """Output column names."""

    left: str = "Value_x"
    right: str = "Value_y"
    difference: str = "Diff Abs"
    percent: str = "Diff %"
    reason: str = "Motivo"


def _difference(x: Column, y: Column, mode: str) -> Column:
    both = x.isNotNull() & y.isNotNull()
    inner = x - y if mode == "signed" else F.abs(x - y)
    return F.when(both, inner).otherwise(F.greatest(x, y))


def _percent(x: Column, y: Column, mode: str) -> Column:
    base, other = (y, x) if mode == "rounded" else (x, y)
    both = x.isNotNull() & y.isNotNull()
    return (
        F.when(base == 0, F.lit(-1.0)).when(both, ratio(other, base) - 1).otherwise(F.lit(-1.0))
    )


def add_differences(
    df: DataFrame,
    mode: str = "abs",
    names: Names = Names(),
    labels: Labels = Labels(),
) -> DataFrame:
    """Difference, relative difference and reason of two value columns.

    ``abs``      |x - y|, relative to x;
    ``signed``   x - y, relative to x;
    ``rounded``  both rounded half-even to 2 digits first, |x - y|, relative to y.

    A missing side gives the present value as difference and -1 as relative difference;
    a zero base gives -1.
    """
    if mode not in ("abs", "signed", "rounded"):
        raise ValueError(f"unknown mode {mode}")
    x, y = F.col(f"`{names.left}`"), F.col(f"`{names.right}`")
    if mode == "rounded":
        df = df.withColumns({names.left: F.bround(x, 2), names.right: F.bround(y, 2)})
    difference = _difference(x, y, mode)
    missing = x.isNull() | y.isNull()
    reason = (
        F.when(missing, labels.missing).when(difference == 0, labels.equal).otherwise(labels.unknown)
    )
    return df.withColumns(
        {names.difference: difference, names.percent: _percent(x, y, mode), names.reason: reason}
    )


# Decimal that holds each whole-number type.
_WHOLE = {"tinyint": (3, 0), "smallint": (5, 0), "int": (10, 0), "bigint": (20, 0)}


def common_type(types: Sequence[T.DataType]) -> str:
    """Type in which values of several types are summed: their own when they agree, the decimal
    that holds all when they are decimals or whole numbers, double otherwise."""
    names = {t.simpleString() for t in types}
    if len(names) == 1:
        return names.pop()
    sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else _WHOLE.get(t.simpleString()) for t in types]
    if None in sizes:
        return "double"
    scale = max(s for _, s in sizes)
    digits = max(p - s for p, s in sizes) + scale
    if digits > 38:
        return "double"
    return f"decimal({digits},{scale})"


def side_by_side(sources: Mapping[str, DataFrame], keys: Sequence[str], value: str = "Value") -> DataFrame:
    """Sum of each source per key, one column per source name."""
    common = common_type([df.schema[value].dataType for df in sources.values()])

    def stack(name: str, df: DataFrame) -> DataFrame:
        own = F.coalesce(F.col(f"`{value}`").cast(common), F.lit(0).cast(common))
        return df.select(
            *[F.col(f"`{k}`") for k in keys],
            *[(own if n == name else F.lit(None).cast(common)).alias(n) for n in sources],
        )

    stacked = reduce(DataFrame.unionByName, [stack(n, df) for n, df in sources.items()])
    return stacked.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[F.sum(f"`{n}`").alias(n) for n in sources]
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    mode: str = "abs",
    value: str = "Value",
    names: Names = Names(),
    labels: Labels = Labels(),
) -> DataFrame:
    """Every key of either fact, both values, and how they differ."""
    paired = side_by_side({names.left: left, names.right: right}, keys, value)
    return add_differences(paired, mode, names, labels)


def reconcile_rollup(
    coarse: DataFrame,
    fine: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str] = (),
    mode: str = "rounded",
    value: str = "Value",
    names: Names = Names(),
    labels: Labels = Labels(),
) -> DataFrame:
    """Compare a coarse fact with a finer one at the coarse keys.

    The finer side is summed by the comparison itself. ``carry`` are columns of the coarse
    side that are constant per key (its placeholder product); keys found only on the fine
    side have null there.
    """
    common = common_type([coarse.schema[value].dataType, fine.schema[value].dataType])
    own = F.coalesce(F.col(f"`{value}`").cast(common), F.lit(0).cast(common))
    none = F.lit(None).cast(common)
    k = [F.col(f"`{c}`") for c in keys]
    carried = [F.col(f"`{c}`") for c in carry]
    empty = [F.lit(None).cast(coarse.schema[c].dataType).alias(c) for c in carry]
    stacked = coarse.select(*k, *carried, own.alias(names.left), none.alias(names.right)).unionByName(
        fine.select(*k, *empty, none.alias(names.left), own.alias(names.right))
    )
    paired = stacked.groupBy(*k).agg(
        *[F.min(f"`{c}`").alias(c) for c in carry],
        F.sum(f"`{names.left}`").alias(names.left),
        F.sum(f"`{names.right}`").alias(names.right),
    )
    return add_differences(paired, mode, names, labels)


def reconcile_chain(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str],
    pairs: Sequence[tuple[str, str]] | None = None,
    mode: str = "rounded",
    value: str = "Value",
    comparison: str = "Comparativa",
    separator: str = " vs ",
    names: Names = Names(),
    labels: Labels = Labels(),
) -> DataFrame:
    """Compare neighbouring sources, A with B, B with C and so on, in one pass.

    Each source is read once and shuffled once, however many pairs it is part of. The
    comparison is labelled ``A vs B``; keys that neither source of a pair has are left out.
    """
    order = list(sources)
    pairs = list(pairs) if pairs is not None else list(zip(order, order[1:]))
    paired = side_by_side(sources, keys, value)
    rows = F.array(
        *[
            F.struct(
                F.lit(a + separator + b).alias(comparison),
                F.col(f"`{a}`").alias(names.left),
                F.col(f"`{b}`").alias(names.right),
            )
            for a, b in pairs
        ]
    )
    long = paired.select(*[F.col(f"`{k}`") for k in keys], F.inline(rows))
    present = F.col(f"`{names.left}`").isNotNull() | F.col(f"`{names.right}`").isNotNull()
    return add_differences(long.filter(present), mode, names, labels)


def labelled_union(frames: Mapping[str, DataFrame], label: str = "Validation") -> DataFrame:
    """Stack frames with the same columns, each with its name in a label column."""
    return reduce(
        DataFrame.unionByName, [df.withColumn(label, F.lit(name)) for name, df in frames.items()]
    )


def keep_differences(df: DataFrame, reason: str = "Motivo", equal: str = Labels().equal) -> DataFrame:
    """Rows that are not marked as equal; a missing reason counts as a difference."""
    return df.filter(~F.col(f"`{reason}`").eqNullSafe(F.lit(equal)))
