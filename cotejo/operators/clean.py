"""Bringing a source to the common long fact (keys, month, metric, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.operators.filters import recent_years
from cotejo.operators.reshape import melt_sum


@dataclass(frozen=True)
class SourceSpec:
    """How one source becomes a long fact.

    ``rename``    source name -> common name;
    ``derive``    computed columns, applied in order (month date, cleaned text, codes);
    ``literals``  constant columns (institution, placeholder product);
    ``where``     row filter, on the columns after ``derive``;
    ``back``      years before the newest one that are kept, all when None;
    ``raw``       the date column, after ``rename``, that ``date`` is derived from: the years are
                  then bounded on it, and the scan sees the bound;
    ``keys``      dimensions of the fact, ``date`` among them;
    ``measures``  columns that become metrics;
    ``exact``     decimal type to sum in.
    """

    keys: Sequence[str]
    measures: Sequence[str]
    rename: Mapping[str, str] = field(default_factory=dict)
    derive: Mapping[str, Column] = field(default_factory=dict)
    literals: Mapping[str, object] = field(default_factory=dict)
    where: Column | None = None
    date: str = "Date"
    back: int | None = None
    raw: str | None = None
    as_of: date | None = None
    exact: str | None = None
    variable: str = "Metric"
    value: str = "Value"


def clean_source(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rename, derive, filter, keep recent years, sum and melt."""
    df = df.withColumnsRenamed(dict(spec.rename))
    for name, column in spec.derive.items():
        df = df.withColumn(name, column)
    df = df.withColumns({name: F.lit(value) for name, value in spec.literals.items()})
    if spec.where is not None:
        df = df.filter(spec.where)
    if spec.back is not None:
        df = recent_years(df, spec.raw or spec.date, spec.back, spec.as_of)
    return melt_sum(df, spec.keys, spec.measures, spec.variable, spec.value, spec.exact)
