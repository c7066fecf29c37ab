"""Character references of HTML."""

from __future__ import annotations

import html.entities
import json
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col

# A reference, a stretch without any, or an ampersand that begins none.
_PIECES = r"(&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[A-Za-z][A-Za-z0-9]*+;?|[^&]++|&)"
REPLACEMENT = "�"


def _windows_signs() -> dict[str, str]:
    """Code points 128 to 159, which stand for the signs of the Windows code page."""
    return {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}


# Maps that the names are dealt to: a map is searched entry by entry, these have a few entries each.
_BUCKETS = 1024


@lru_cache(maxsize=1)
def _named() -> tuple[str, str]:
    """References of the language's own table, as JSON array of maps by the CRC-32 of the
    reference, and the pattern of those that need no semicolon, longest first."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, sign in html.entities.html5.items():
        buckets[zlib.crc32(f"&{name}".encode()) % _BUCKETS][f"&{name}"] = sign
    short = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return json.dumps(buckets), "^(&(?:" + "|".join(map(re.escape, short)) + "))"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _of_code_point(number: Column) -> Column:
    """Sign of a code point; those that are no characters become the replacement sign."""
    signs = F.from_json(F.lit(json.dumps(_windows_signs())), "map<string,string>")

    def sign(n: Column) -> Column:
        wrong = n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        # The four bytes of the number, read as one character.
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return (
            F.when(wrong, F.lit(REPLACEMENT))
            .when(n.between(128, 159), F.coalesce(F.try_element_at(signs, n.cast("string")), plain))
            .otherwise(plain)
        )

    return bound(number, sign)


def unescape(c: Column | str) -> Column:
    """Text with decimal, hexadecimal and named character references resolved, as browsers do:
    the semicolon may be missing after numbers and after the old names. Text is resolved once;
    what a reference makes is not read again."""
    names_json, short = _named()
    names = F.from_json(F.lit(names_json), "array<map<string,string>>")

    def by_name(reference: Column) -> Column:
        bucket = F.pmod(F.crc32(reference.cast("binary")), F.lit(_BUCKETS)).cast("int")
        return F.try_element_at(F.get(names, bucket), reference)

    def by_old_name(p: Column) -> Column:
        return bound(
            F.regexp_extract(p, short, 1),
            lambda old: F.when(old != "", F.concat(by_name(old), F.substring(p, F.length(old) + 1, F.length(p)))),
        )

    def number(p: Column, pattern: str, value: Callable[[Column], Column]) -> Column:
        digits = F.regexp_extract(p, pattern, 1)
        return _of_code_point(bound(digits, lambda d: F.when(d != "", value(d).try_cast("bigint")).otherwise(_zeros(p))))

    def piece(p: Column) -> Column:
        return (
            F.when(~p.startswith("&") | (p == "&"), p)
            .when(p.startswith("&#x") | p.startswith("&#X"), number(p, "^&#[xX]0*([0-9a-fA-F]{1,7});?$", lambda d: F.conv(d, 16, 10)))
            .when(p.startswith("&#"), number(p, "^&#0*([0-9]{1,9});?$", lambda d: d))
            .otherwise(F.coalesce(by_name(p), by_old_name(p), p))
        )

    def text(t: Column) -> Column:
        whole = F.array_join(F.transform(F.regexp_extract_all(t, F.lit(_PIECES), F.lit(1)), piece), "")
        return F.when(t.contains("&"), whole).otherwise(t)

    return bound(_col(c), text)


def _zeros(p: Column) -> Column:
    """Number of a reference with no digit but zeros (0), or with too many digits (beyond all)."""
    return F.when(p.rlike("^&#[xX]?0++;?$"), F.lit(0)).otherwise(F.lit(0x110000)).cast("bigint")
