"""Replacing values by small constant dictionaries.

Dictionaries here are literals of the program. A dictionary kept in a table is a join,
see ``operators.joins.dict_lookup``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col


def _lookup(c: Column, mapping: Mapping) -> Column:
    entries = [F.lit(item) for pair in mapping.items() if pair[0] is not None for item in pair]
    found = F.try_element_at(F.create_map(*entries), c)
    if None in mapping:
        return F.when(c.isNull(), F.lit(mapping[None])).otherwise(found)
    return found


def map_values(c: Column | str, mapping: Mapping) -> Column:
    """Mapped value, null for a value that is not in the dictionary."""
    return _lookup(_col(c), mapping)


def replace_values(c: Column | str, mapping: Mapping) -> Column:
    """Mapped value, the value itself when it is not in the dictionary."""
    c = _col(c)
    return F.coalesce(_lookup(c, mapping), c)


def map_or_else(c: Column | str, mapping: Mapping, fallback: Column | str) -> Column:
    """Mapped value, another column when the value is not in the dictionary."""
    return F.coalesce(_lookup(_col(c), mapping), _col(fallback))


def inverted(mapping: Mapping) -> dict:
    """Dictionary with keys and values exchanged; of equal values the last one stays."""
    return {value: key for key, value in mapping.items()}


def bucket_other(c: Column | str, rare: Sequence[str], label: str = "otros") -> Column:
    """Put listed values, blanks and nulls into one bucket."""
    c = _col(c)
    return F.when(c.isNull() | c.isin("", *rare), F.lit(label)).otherwise(c)
