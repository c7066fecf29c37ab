"""Text cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space removed by `strip` (ASCII, separators U+001C to U+001F, Unicode).
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Letters with case, and marks that count as lower case letters (the ordinals in `Nº`, `1ª`).
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
# Runs of cased letters, and the runs between them.
_CASED_RUNS = f"([{_CASED}]+|[^{_CASED}]+)"
# Places where a word begins that does not follow a blank.
_INNER_WORD = f"(?<=[^{_CASED} ])(?=[{_CASED}])"
# A character that never stands in text (Unicode noncharacter), before a blank.
_MARK = "\uffff "
# Blocks with letters whose capital form is longer than themselves.
_LONG_CAPITALS = (
    r"[\u00df\u0149\u01f0\u0390\u03b0\u0587\u1e96-\u1e9a\u1f50-\u1f57\u1f80-\u1fff\ufb00-\ufb17\uffff]"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: Column | str) -> Column:
    """Raise every letter that follows a non-letter, lower the others.

    ``initcap`` only looks at blanks; here ``a-word`` gives ``A-Word`` and ``1x1800mg``
    gives ``1X1800Mg``. A marked blank is put before each inner word, ``initcap`` does the
    rest, and the marks are taken out again: three string functions, all in generated code.
    Texts with letters that have no capital of their own (``ß`` gives ``Ss``) go the longer
    way over the runs of letters.
    """
    low = F.lower(_col(c))
    marked = F.regexp_replace(low, _INNER_WORD, _MARK)
    short = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    runs = F.regexp_extract_all(low, F.lit(_CASED_RUNS), F.lit(1))
    long = F.array_join(
        F.transform(
            runs, lambda run: F.concat(F.initcap(F.upper(F.left(run, F.lit(1)))), F.substr(run, F.lit(2)))
        ),
        "",
    )
    return F.when(low.rlike(_LONG_CAPITALS), long).otherwise(short)


def title_after_dash(c: Column | str) -> Column:
    """Title case for what follows the first dash; text without a dash is unchanged."""
    c = _col(c)
    parts = F.split(c, "-", 2)
    return F.when(F.instr(c, "-") > 0, F.concat(parts[0], F.lit("-"), title_case(parts[1]))).otherwise(c)


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes blanks only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def strip_leading_zeros(c: Column | str) -> Column:
    return F.ltrim(_col(c), F.lit("0"))


def capitalize(c: Column | str) -> Column:
    """First character raised, the rest lowered."""
    c = _col(c)
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def suffix(c: Column | str, n: int) -> Column:
    return F.right(_col(c), F.lit(n))


def prefix(c: Column | str, n: int) -> Column:
    return F.left(_col(c), F.lit(n))


def zero_pad(c: Column | str, width: int) -> Column:
    """Pad with zeros on the left after a sign; longer text is kept (``lpad`` would cut it)."""
    c = _col(c)
    signed = F.left(c, F.lit(1)).isin("+", "-")
    padded = F.when(
        signed, F.concat(F.left(c, F.lit(1)), F.lpad(F.substr(c, F.lit(2)), width - 1, "0"))
    ).otherwise(F.lpad(c, width, "0"))
    return F.when(F.length(c) >= width, c).otherwise(padded)


def split_once(c: Column | str, separator: str) -> Column:
    """Array of one or two parts, cut at the first separator."""
    quoted = "\\Q" + separator + "\\E"
    return F.split(_col(c), quoted, 2)


def any_of(patterns: Sequence[str], ignore_case: bool = False) -> str:
    """One pattern with a single group for a list of alternatives; the leftmost one wins."""
    return ("(?i)" if ignore_case else "") + "(" + "|".join(patterns) + ")"


def extract_any(c: Column | str, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    """First alternative found in the text, null when there is none."""
    return F.nullif(F.regexp_extract(_col(c), any_of(patterns, ignore_case), 1), F.lit(""))


def contains_any(c: Column | str, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    return _col(c).rlike(any_of(patterns, ignore_case))


def json_text(c: Column | str, path: str) -> Column:
    """Text field of a JSON string; blank input gives blank text."""
    c = _col(c)
    return F.when(c == "", F.lit("")).otherwise(F.get_json_object(c, path))
