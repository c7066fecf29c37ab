"""Stored SQL statements."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from importlib import resources
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_sql(path: str) -> str:
    """Text of a statement: a file path, or the name of a statement shipped in ``plans/sql``."""
    file = Path(path)
    if file.is_file():
        return file.read_text(encoding="utf-8")
    return resources.files("cotejo.plans").joinpath("sql", path).read_text(encoding="utf-8")


def run_sql_file(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame],
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a stored statement. ``{name}`` in it stands for a table, ``:name`` for a value."""
    return spark.sql(read_sql(path), args=dict(args or {}), **tables)


# A quoted text, a quoted name, a comment, a cast, a table or a value; all else is left as it is.
_TOKENS = re.compile(
    r"""('(?:[^']|'')*')|("(?:[^"]|"")*")|(--[^\n]*)|(::)|\{(?P<table>\w+)\}|:(?P<value>[A-Za-z_]\w*)"""
)
_NAME = re.compile(r'(?:\w+|"[^"]+")(?:\.(?:\w+|"[^"]+"))*')


def literal(value: Any) -> str:
    """A value as it is written in a statement."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"{value} cannot be written in a statement")
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (list, tuple)):
        return "ARRAY[" + ", ".join(map(literal, value)) + "]"
    raise TypeError(f"no literal for {type(value).__name__}")


def render_sql(text: str, tables: Mapping[str, str], args: Mapping[str, Any]) -> str:
    """The statement for a remote database: ``{name}`` becomes the name of a table there, ``:name``
    a literal. Quoted text, comments and casts are left alone; a name that is missing, a table
    name that is none, and an argument that the statement does not use are errors."""
    used: set[str] = set()

    def replaced(match: re.Match) -> str:
        if match["table"]:
            name = tables[match["table"]]
            if not _NAME.fullmatch(name):
                raise ValueError(f"not a table name: {name}")
            used.add(match["table"])
            return name
        if match["value"]:
            used.add(match["value"])
            return literal(args[match["value"]])
        return match[0]

    rendered = _TOKENS.sub(replaced, text).strip().rstrip(";")
    unused = (set(tables) | set(args)) - used
    if unused:
        raise ValueError(f"not in the statement: {', '.join(sorted(unused))}")
    return rendered


def month_predicates(column: str, first: date, last: date, months: int = 1) -> list[str]:
    """Conditions that cut a date or ``yyyy-MM-dd`` text column into ranges of ``months``, from the
    month of ``first`` to that of ``last``; what is before, after or null has a range of its own,
    so that each row is in just one."""

    def start(n: int) -> str:
        return literal(f"{n // 12:04d}-{n % 12 + 1:02d}-01")

    low, high = (d.year * 12 + d.month - 1 for d in (first, last))
    if low > high:
        raise ValueError("the first month is after the last")
    borders = [*range(low, high + 1, months), high + 1]
    ranges = [f"{column} >= {start(a)} AND {column} < {start(b)}" for a, b in zip(borders, borders[1:])]
    outside = f"{column} < {start(low)} OR {column} >= {start(high + 1)} OR {column} IS NULL"
    return [*ranges, outside]


@dataclass(frozen=True)
class LakeRead:
    """What a read of the remote database asks for: the statement as a table, and one condition
    per partition (none: one partition)."""

    table: str
    predicates: tuple[str, ...] = ()

    def statements(self) -> list[str]:
        """The statement that each partition sends."""
        return [f"SELECT * FROM {self.table} WHERE {p}" for p in self.predicates] or [f"SELECT * FROM {self.table}"]


def plan_lake_read(
    text: str, tables: Mapping[str, str], args: Mapping[str, Any] | None = None, predicates: Sequence[str] = ()
) -> LakeRead:
    return LakeRead(f"({render_sql(text, tables, args or {})}\n) q", tuple(predicates))


def read_lake(
    spark: SparkSession,
    url: str,
    path: str,
    tables: Mapping[str, str],
    args: Mapping[str, Any] | None = None,
    predicates: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """Run a stored statement on a remote database over JDBC, one connection per predicate (see
    ``month_predicates``), so that a large result is read by many tasks."""
    plan = plan_lake_read(read_sql(path), tables, args, predicates)
    if plan.predicates:
        return spark.read.jdbc(url, plan.table, predicates=list(plan.predicates), properties=dict(options))
    return spark.read.format("jdbc").options(url=url, dbtable=plan.table, **options).load()
