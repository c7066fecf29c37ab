"""Rows that used to be cut or dropped, and results that must not depend on order."""

import datetime

import pytest
from pyspark.sql import functions as F

from cotejo.operators import dashboard, filters, joins, reconcile, reshape
from cotejo.operators.aggregates import group_sum
from cotejo.sources import delimited as dl
from cotejo.sources.payload_text import text_to_table


def test_group_sum_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 5.0), ("a", 1.0), (None, 2.0)], "k string, v double")
    assert {tuple(r) for r in group_sum(df, ["k"], ["v"], keep_nulls=True).collect()} == {(None, 7.0), ("a", 1.0)}


def test_text_past_the_asked_columns_and_quoted_line_breaks(spark):
    text = 'a,b,c,d\n1,"x\ny ""z""",,4\r\n5,6\n'
    got = text_to_table(spark.createDataFrame([(1, text)], "i int, t string"), ["i"], "t", ["d", "b"]).orderBy("row_no").collect()
    assert [(r.d, r.b) for r in got] == [("4", 'x\ny "z"'), (None, "6")]


def test_long_quoted_cell(spark):
    text = 'a,b\n1,"' + "x,\n" * 20_000 + '"\n'
    assert text_to_table(spark.createDataFrame([(1, text)], "i int, t string"), ["i"], "t", ["b"]).count() == 1


def sheet(months):
    return [["", "2020"], ["", "P"], *[[str(m), str(m)] for m in range(1, months + 1)]]


def test_sheet_rows_are_not_cut(spark):
    read = lambda rows: reshape.crosstab_to_long(spark.createDataFrame([(1, rows)], "i int, rows array<array<string>>"), ["i"], "rows", {"U": "P"}, 1, 2)
    assert read(sheet(12)).count() == 12
    assert read([*sheet(12), ["", " "], ["", ""]]).count() == 12
    with pytest.raises(Exception, match="below the twelfth month"):
        read(sheet(14)).collect()


def test_pivot_rest(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (1, None, 4)], "i int, k string, TOTAL int").withColumn("MAX_DATE", F.lit("d"))
    row = reshape.pivot_sum_max(df, ["i"], "k", {"a": "A"}, rest="REST").first()
    assert (row.TOTAL_A, row.TOTAL_REST, row.DATE_REST) == (2, 7, "d")


def test_drop_totals_and_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("Grand Total",)], "k string")
    assert {r.k for r in filters.drop_totals(df, "k").collect()} == {"a", None}
    assert {r.k for r in filters.drop_totals(df, "k", null_is_total=True).collect()} == {"a"}


def test_malformed_documents_are_listed(spark):
    df = spark.createDataFrame([(1, "{}"), (2, "{oops"), (3, None), (4, "[1]")], "i int, d string")
    assert [tuple(r) for r in dashboard.malformed(df, ["i"], "d").orderBy("i").collect()] == [(2, "not JSON"), (4, "not an object")]


def test_dates_inside_months_count_for_their_month(spark):
    days = [datetime.date(2020, 1, 15), datetime.date(2020, 2, 20), datetime.date(2020, 4, 2)]
    df = spark.createDataFrame([("s", d, 1.0) for d in days], "s string, Date date, Value double")
    got = reshape.densify_months(df, ["s"], "Date", "Value").orderBy("Date").collect()
    assert [(r.Date.month, r.Date.day, r.Value) for r in got] == [(1, 1, 1.0), (2, 1, 1.0), (3, 1, 0.0), (4, 1, 1.0)]


def test_salted_join_of_equal_rows_and_nulls(spark):
    equal = spark.range(1000).select(F.lit("hot").alias("k"), F.lit("p").alias("p"))
    other = spark.range(500).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("p"))
    fact = equal.unionByName(other).unionByName(spark.createDataFrame([(None, "n"), (None, "n"), ("x", "y")], "k string, p string"))
    dim = spark.createDataFrame([("hot", 1), (None, 2)], "k string, v int")
    plain = joins.lookup_join(fact, dim, ["k"])
    for how in ("left", "inner", "left_semi", "left_anti"):
        salted, plain = joins.lookup_join(fact, dim, ["k"], how, salts=16), joins.lookup_join(fact, dim, ["k"], how)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).count() == plain.exceptAll(salted).count() == 0
    fact = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("p"))
    salts = fact.select(F.pmod(F.xxhash64("k", "p"), F.lit(16)).alias("s")).distinct().count()
    assert salts == 16


def test_read_by_header(spark, tmp_path):
    for name, text in {"a": "A|B\n1|2\n", "b": "B|A\n20|10\n", "c": "A|X|B\n100|9|200\n", "d": "﻿A\n7\n"}.items():
        (tmp_path / name).write_text(text, encoding="utf8")
    df = dl.read_by_header(spark, [str(tmp_path / n) for n in "abcd"], dl.text_schema(["A", "B"], {"A": "int"}), "|")
    assert sorted(tuple(r) for r in df.collect() if r.B) == [(1, "2"), (10, "20"), (100, "200")]
    assert [r.A for r in df.collect() if not r.B] == [7]
    with pytest.raises(Exception, match="header"):
        dl.read_delimited(spark, str(tmp_path / "b"), dl.text_schema(["A", "B"]), "|").collect()


def test_exact_sums_reconcile(spark):
    left = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3)], "k string, Value double")
    right = spark.createDataFrame([("a", 0.6)], "k string, Value double")
    sums = [group_sum(d, ["k"], ["Value"], "decimal(28,6)").withColumn("Value", F.col("Value").cast("double")) for d in (left, right)]
    row = reconcile.reconcile(*sums, ["k"], mode="abs").first().asDict()
    assert "Sin diferencias" in row.values()


def test_html_attributes(spark):
    page = (
        '<param data-name="x" name="host_url" value="https%3A%2F%2Fa%2Bb"><param name=plain value=1+1>'
        "<param name='q' value=\"it's\"><param value='none'><param name='q' value='a>b &amp;lt;'>"
        '<textarea id="x">{&quot;a&quot;: 1}</textarea>'
    )
    df = spark.createDataFrame([(page,)], "html string")
    row = dashboard.with_html_params(df, "html").withColumn("config", dashboard.html_text_of("html", "textarea", "x")).first()
    assert row.params == {"host_url": "https://a+b", "plain": "1+1", "q": "a>b &lt;"}
    assert row.config == '{"a": 1}'


def test_salted_lookup_is_not_broadcast_with_its_copies(spark):
    fact = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    joined = joins.lookup_join(fact, dim, ["k"], salts=16)
    assert joined.count() == 1000
    # The lookup alone is small enough to be broadcast, its copies are not.
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().toString()
