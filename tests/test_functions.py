from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cotejo.functions import dates, mapping, numbers
from cotejo.functions import text as tx

C = "c"


def test_title_case_follows_every_non_letter(values):
    items = ["some-word", "1x1800mg VIAL", "o'NEIL", "ñandú del SUR", "straße", "ßa", "nºa 1ªB", "", None, "a\tb\nc", "  x"]
    expected = [None if v is None else v.title() for v in items]
    assert values(items, tx.title_case(C)) == expected


# Three letters whose case differs between Java and Python are left out (see README).
LATIN = st.characters(min_codepoint=32, max_codepoint=0x24F, exclude_characters="\u0130\u0149\u019b")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=LATIN), min_size=1, max_size=200))
def test_title_case_equals_python(values, items):
    assert values(items, tx.title_case(C)) == [v.title() for v in items]


def test_title_after_dash(values):
    assert values(["L01-SOME drug-X", "NO DASH", None], tx.title_after_dash(C)) == ["L01-Some Drug-X", "NO DASH", None]


def test_strip_takes_every_white_space(values):
    assert values([" \t a b \n", ""], tx.strip(C)) == ["a b", ""]


def test_zero_pad_never_cuts(values):
    items = ["1", "12", "123", "-1", "+5", ""]
    assert values(items, tx.zero_pad(C, 2)) == [v.zfill(2) for v in items]
    assert values(items, tx.zero_pad(C, 4)) == [v.zfill(4) for v in items]


def test_slices_and_case(values):
    assert values(["0012a", "000", "abc"], tx.strip_leading_zeros(C)) == ["12a", "", "abc"]
    assert values(["123456789", "12"], tx.suffix(C, 8)) == ["23456789", "12"]
    assert values(["123456789", "12"], tx.prefix(C, 6)) == ["123456", "12"]
    assert values(["hELLO wORLD", ""], tx.capitalize(C)) == ["Hello world", ""]
    assert values(["a.b.c", "abc"], tx.split_once(C, ".")) == [["a", "b.c"], ["abc"]]


def test_extract_takes_the_leftmost_alternative(values):
    words = ["DARK", "DARK PLUS"]
    assert values(["x DARK PLUS", "none", None], tx.extract_any(C, words)) == ["DARK", None, None]
    assert values(["x dark"], tx.extract_any(C, words, ignore_case=True)) == ["dark"]
    assert values(["x dark", "y"], tx.contains_any(C, words)) == [True, False]


def test_json_text(values):
    assert values(['{"h": "x"}', "", "bad"], tx.json_text(C, "$.h")) == ["x", "", None]


def test_parse_number_and_rounding(values):
    assert values(["$1,234.50", "7", "x", None], numbers.parse_number(C)) == [1234.5, 7.0, None, None]
    assert values([0.125, 0.375, 2.5], numbers.round_half_even(C, 2), "double") == [0.12, 0.38, 2.5]
    assert values([12345.0], numbers.scale_and_round(C, 100000), "double") == [0.12]


def test_months(values):
    assert values(["1", "12", "13", "x", None], dates.month_from_parts(F.lit("2024"), C)) == [
        date(2024, 1, 1), date(2024, 12, 1), None, None, None,
    ]
    assert values(["202403", "2024-03", "2024-03-17 00:00", "bad"], dates.month_from_compact(C)) == [
        date(2024, 3, 1)] * 3 + [None]
    assert values(["ENERO", "march", "Diciembre", "nope"], dates.month_number(C)) == [1, 3, 12, None]
    assert values(["5"], dates.month_text(F.lit(2024), C)) == ["2024-05-01"]
    assert values(["20240131", "2024-01-31", "31/01/2024"], dates.parse_date(C, ["yyyyMMdd", "yyyy-MM-dd"])) == [
        date(2024, 1, 31), date(2024, 1, 31), None,
    ]


def test_run_stamp_is_the_given_time(values):
    assert values(["a"], dates.run_stamp(datetime(2024, 5, 6, 7, 8, 9))) == ["2024-05-06 07:08"]


def test_maps(values):
    codes = {"a": "A", None: "none"}
    assert values(["a", "b", None], mapping.map_values(C, codes)) == ["A", None, "none"]
    assert values(["a", "b", None], mapping.replace_values(C, codes)) == ["A", "b", "none"]
    assert values(["a", "b"], mapping.map_or_else(C, codes, F.lit("z"))) == ["A", "z"]
    assert mapping.inverted({"x": 1, "y": 1}) == {1: "y"}
    assert values(["x", "", None, "keep"], mapping.bucket_other(C, ["x"])) == ["otros", "otros", "otros", "keep"]
