"""Joins.

There are no broadcast hints in this package: the planner broadcasts a side only when its
size, by statistics or as measured by AQE, is under ``spark.sql.autoBroadcastJoinThreshold``,
and shuffles both sides otherwise. For a hot key on the fact side of a shuffled join,
``salts`` collapses equal rows to one with a count, spreads the different ones by a hash of the
row, and unfolds them after the join; a task that runs twice gives the same rows. Such a join
is always shuffled: statistics do not count the copies of the lookup rows, and a lookup that
is just under the threshold would be broadcast ``salts`` times as large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.operators.aggregates import distinct_on


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", salts: int = 1
) -> DataFrame:
    """Join a fact to a lookup table; several lookup rows per key fan out.

    With ``salts`` > 1 equal fact rows are joined as one, each lookup row is repeated ``salts``
    times and each different fact row goes to one of the copies: a key with a third of the fact
    is then spread over ``salts`` tasks. Rows with a null key match nothing and are not joined.
    """
    on = list(on)
    if salts <= 1:
        return fact.join(dim, on, how)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"salting needs a join that keeps or drops fact rows, not {how}")
    keyed = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in on])
    counted = fact.filter(keyed).groupBy(*[F.col(f"`{c}`") for c in fact.columns]).agg(F.count(F.lit(1)).alias("__n"))
    salted_fact = counted.withColumn("__salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_dim = dim.withColumn("__salt", copies)
    joined = salted_fact.join(salted_dim.hint("merge"), [*on, "__salt"], how).drop("__salt")
    unfolded = _unfold(joined, "__n")
    if how in ("inner", "left_semi"):
        return unfolded
    return unfolded.unionByName(fact.filter(~keyed), allowMissingColumns=True)


# Copies of a row that are made at a time.
UNFOLDED = 10_000


def _unfold(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as ``count`` says, and without it.

    A row that stands once, as most do, makes no array but a shared constant. Others are made in
    chunks: one row per UNFOLDED copies, and then the copies of each, so that no array grows
    with the count.
    """
    n = F.col(count)
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / UNFOLDED))
    by_chunk = df.withColumn("__chunk", F.explode(F.when(n <= UNFOLDED, F.array(F.lit(0).cast("long"))).otherwise(chunks)))
    here = F.least(n - F.col("__chunk") * UNFOLDED, F.lit(UNFOLDED)).cast("int")
    copies = F.when(n == 1, F.array(F.lit(0))).otherwise(F.array_repeat(F.lit(0), here))
    return by_chunk.withColumn("__copy", F.explode(copies)).drop("__chunk", "__copy", count)


def dict_lookup(
    df: DataFrame,
    column: str,
    table: DataFrame,
    key: str,
    value: str,
    into: str,
    order: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Add the value of a dictionary table, never more than one per row.

    Of several entries with the same key the last by ``order`` counts.
    """
    entries = table.select(
        F.col(key).alias(column),
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
        F.col(value).alias(into),
    ).filter(F.col(column).isNotNull())
    single = distinct_on(entries, [column], [f"__o{i}" for i in range(len(order))], keep="last")
    return lookup_join(df, single.select(column, into), [column], "left", salts)


def keep_known(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(other.select(*on), list(on), "left_semi")


def keep_unknown(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in the other table."""
    return df.join(other.select(*on), list(on), "left_anti")


def full_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which null keys match each other.

    For sides that both carry columns of their own. Comparing measures does not need it, see
    ``operators.reconcile``.
    """
    l, r = left.alias("__l"), right.alias("__r")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
    joined = l.join(r, condition, "full")
    return joined.select(
        *[F.coalesce(F.col(f"__l.`{k}`"), F.col(f"__r.`{k}`")).alias(k) for k in keys],
        *[F.col(f"__l.`{c}`") for c in left.columns if c not in keys],
        *[F.col(f"__r.`{c}`") for c in right.columns if c not in keys],
    )
