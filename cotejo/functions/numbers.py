"""Numbers held as text, rounding and row-wise arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col

MONEY = "decimal(18,2)"
LAKE_DECIMAL = "decimal(28,6)"


def parse_number(c: Column | str, drop: str = "[$,]", to: str = "double") -> Column:
    """Number out of text such as ``$1,234.50``; text that is no number gives null.

    ``drop`` is a pattern. A class of plain signs, or one sign, is dropped sign by sign, which is
    several times as fast.
    """
    signs = re.fullmatch(r"\[([^\]\[\\^&-]+)\]|([^\\^$.|?*+()\[\]{}])", drop)
    c = _col(c)
    plain = F.translate(c, signs[1] or signs[2], "") if signs else F.regexp_replace(c, drop, "")
    return plain.try_cast(to)


def scale_and_round(c: Column | str, divisor: float, digits: int = 2) -> Column:
    return F.bround(_col(c) / F.lit(divisor), digits)


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(_col(c), digits)


def row_max(*cols: Column | str) -> Column:
    """Greatest value of the row; nulls are skipped."""
    return F.greatest(*[_col(c) for c in cols])


def null_to_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, null when the denominator is zero or a side is null."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
