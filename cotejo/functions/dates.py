"""Month handling: all facts are monthly, a month is the date of its first day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.mapping import map_values
from cotejo.functions.text import _col, zero_pad

# Month names, Spanish then English.
SPANISH_MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
ENGLISH_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MONTH_NUMBERS = {
    name: number
    for names in (SPANISH_MONTHS, ENGLISH_MONTHS)
    for number, name in enumerate(names, start=1)
}


def month_number(c: Column | str) -> Column:
    """Month number of a Spanish or English month name in any case, null when unknown."""
    return map_values(F.lower(_col(c)), {name.lower(): number for name, number in MONTH_NUMBERS.items()})


def month_from_parts(year: Column | str, month: Column | str) -> Column:
    """First day of a month given as two columns (text or number); bad parts give null."""
    y = _col(year).try_cast("int")
    m = _col(month).try_cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def month_text(year: Column | str, month: Column | str) -> Column:
    """The same month as text ``yyyy-MM-01``, the form used by the lake tables."""
    return F.concat(
        _col(year).cast("string"), F.lit("-"), zero_pad(_col(month).cast("string"), 2), F.lit("-01")
    )


def month_from_compact(c: Column | str) -> Column:
    """First day of the month out of ``yyyyMM``, ``yyyy-MM`` or a longer date text."""
    digits = F.left(F.translate(_col(c).cast("string"), "-", ""), F.lit(6))
    whole = (F.length(digits) == 6) & (F.translate(digits, "0123456789", "") == "")
    return F.when(whole, month_from_parts(F.left(digits, F.lit(4)), F.right(digits, F.lit(2))))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def parse_date(c: Column | str, formats: Sequence[str]) -> Column:
    """Date by the first format that fits, null when none does."""
    return F.coalesce(*[F.try_to_date(_col(c), fmt) for fmt in formats])


def shift_months(c: Column | str, months: int) -> Column:
    return F.add_months(_col(c), months)


def month_range(first: Column | str, last: Column | str) -> Column:
    """Array of the months between two months, both included."""
    return F.sequence(_col(first), _col(last), F.expr("interval 1 month"))


def calendar_columns(c: Column | str) -> dict[str, Column]:
    """Quarter, month and year of a date, by name."""
    c = _col(c)
    return {"quarter": F.quarter(c), "month": F.month(c), "year": F.year(c)}


def run_stamp(run_at: datetime) -> Column:
    """Extraction time as text. The time is an argument, so that a run can be repeated."""
    return F.date_format(F.lit(run_at), "yyyy-MM-dd HH:mm")
