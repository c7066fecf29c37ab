"""Tables that arrive as text inside a column (downloaded crosstabs and CSV bodies)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions.arrays import spread

# Inside of a quoted cell: a quote is written twice.
_INSIDE = '(?:[^"]++|"")*+'


def _cell(sep: str) -> str:
    """Pattern of a cell. Only a quote at its start opens a quoted stretch, in which separators and
    line breaks belong to the cell; what follows the closing quote, and quotes elsewhere, are
    plain text. A stretch that is not closed reaches to the end of the text."""
    plain = f"(?:(?!{re.escape(sep)})[^\\r\\n])*+"
    return f'(?:"{_INSIDE}(?:"{plain}|\\z)|(?!"){plain})'


def _records(text, sep: str):
    """Records of the text without blank ones."""
    cell = _cell(sep)
    found = F.regexp_extract_all(text, F.lit(f"({cell}(?:{re.escape(sep)}{cell})*+)(?:\\r\\n|[\\r\\n]|\\z)"), F.lit(1))
    return F.filter(found, lambda r: F.trim(F.replace(r, F.lit("\t"), F.lit(" "))) != "")


def _cells(record, sep: str):
    """Cells of a record, as many as there are, without their quotes."""
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(f"{re.escape(sep)}({_cell(sep)})"), F.lit(1))
    inside = lambda c: F.regexp_extract(c, f'^"({_INSIDE})', 1)
    after = lambda c: F.regexp_extract(c, f'(?s)^"{_INSIDE}"(.*)$', 1)
    return F.transform(
        found,
        lambda c: F.when(c.startswith('"'), F.concat(F.replace(inside(c), F.lit('""'), F.lit('"')), after(c))).otherwise(c),
    )


def text_to_table(
    df: DataFrame,
    ids: Sequence[str],
    text: str,
    columns: Sequence[str],
    sep: str = ",",
    row_number: str = "row_no",
) -> DataFrame:
    """Rows of the delimited text in ``text``, columns found by the names in its first line.

    A text may have any number of columns; one that it lacks is null, an empty cell without
    quotes too. A blank text, or one with a header only, gives no rows. A text is one row of the
    table and is parsed where it is.
    """
    headed = df.select(*ids, _records(F.col(text), sep).alias("__lines")).select(
        *ids, "__lines", _cells(F.get("__lines", F.lit(0)), sep).alias("__head")
    )
    body = F.slice("__lines", 2, F.greatest(F.size("__lines") - 1, F.lit(0)))
    exploded = spread(headed, [*ids, "__head"], body, "__line", position=row_number)
    parsed = exploded.select(*ids, row_number, "__head", _cells(F.col("__line"), sep).alias("__cells"))
    return parsed.select(
        *ids,
        row_number,
        *[
            F.nullif(F.get("__cells", F.array_position("__head", name).cast("int") - 1), F.lit("")).alias(name)
            for name in columns
        ],
    )


def text_to_rows(df: DataFrame, ids: Sequence[str], text: str, into: str, sep: str = "\t") -> DataFrame:
    """The text as array of rows of cells, for ``operators.reshape.crosstab_to_long``."""
    lines = F.split(F.col(text), "\r?\n")
    return df.select(*ids, F.transform(lines, lambda line: F.split(line, sep, -1)).alias(into))
