import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cotejo.operators import aggregates, filters, joins, quality, refresh, reshape, shares
from cotejo.operators.clean import SourceSpec, clean_source


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_group_sum_drops_null_keys_and_sums_nulls_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 1.0), ("b", 2.0)], "k string, v double")
    assert rows(aggregates.group_sum(df, ["k"], ["v"])) == [("a", 0.0), ("b", 2.0)]
    assert rows(aggregates.group_sum(df, ["k"], {"t": "v"}, "decimal(18,2)"))[1][0] == "b"


def test_melt_sum_equals_melting_first(spark):
    random.seed(3)
    data = [(random.choice("abc"), random.choice([1.0, None, 2.5]), random.choice([None, 4.0])) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, p double, q double")
    frame = pd.DataFrame(data, columns=["k", "p", "q"]).melt("k", ["p", "q"], "Metric", "Value")
    expected = frame.groupby(["k", "Metric"])["Value"].sum().reset_index()
    assert rows(reshape.melt_sum(df, ["k"], ["p", "q"])) == rows_of(expected)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.itertuples(index=False)), key=str)


def test_distinct_on_order_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, None, "m")], "k string, o int, v string"
    )
    assert rows(aggregates.distinct_on(df, ["k"], ["o"])) == [("a", 1, "y"), (None, None, "m")]
    assert rows(aggregates.distinct_on(df, ["k"], ["o"], keep="last")) == [("a", 2, "x"), (None, 5, "n")]
    plan = aggregates.distinct_on(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_pivot_absent_is_null_and_null_group_is_zero(spark):
    df = spark.createDataFrame(
        [("i", "F1", None, "2024-01"), ("i", "F2", 3.0, "2024-02"), ("j", "F1", 1.0, "2024-01"), (None, "F1", 1.0, "x")],
        "i string, FUENTE string, TOTAL double, MAX_DATE string",
    )
    wide = reshape.pivot_sum_max(df, ["i"], "FUENTE", {"F1": "STANDARD", "F2": "FREEZE"})
    assert wide.columns == ["i", "DATE_STANDARD", "DATE_FREEZE", "TOTAL_STANDARD", "TOTAL_FREEZE"]
    assert rows(wide) == [("i", "2024-01", "2024-02", 0.0, 3.0), ("j", "2024-01", None, 1.0, None)]


def test_recent_years_with_and_without_given_date(spark):
    df = spark.createDataFrame([(date(y, 5, 1),) for y in range(2015, 2025)], "d date")
    assert filters.recent_years(df, "d", 2).count() == 3
    assert filters.recent_years(df, "d", 2, as_of=date(2020, 1, 1)).count() == 7


def test_scalar_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(date(y, 5, 1), y) for y in range(2015, 2025)], "d date, v int").write.parquet(path)
    df = filters.recent_years(spark.read.parquet(path), "d", 2)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(d,ScalarSubquery" in plan


def test_last_periods_before_first_and_exclusion(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5)], "p string, v int")
    assert rows(filters.last_n_periods(df, "p", 2)) == [("b", 2), ("b", 3), ("c", 4)]
    other = spark.createDataFrame([("b",), ("c",)], "p string")
    assert rows(filters.before_first(df, other, "p")) == [("a", 1)]
    dated = spark.createDataFrame([(date(2023, 5, 2), "f"), (date(2023, 5, 2), "g"), (date(2023, 6, 1), "f"), (None, "f")], "d date, file string")
    assert filters.exclude_month(dated, "d", 2023, 5).count() == 2
    assert filters.exclude_month(dated, "d", 2023, 5, F.col("file") == "f").count() == 3


def test_member_selection(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "m string")
    pick = lambda **k: [r[0] for r in filters.select_members(df, "m", **k).orderBy("m").collect()]
    assert pick(members=["a", "c"]) == ["a", "c", "c"]
    assert pick(members=["b"], selected=["a"]) == ["a", "b"]
    assert pick(members=["b"], selected=["a", "c"], remove=["c"]) == ["a", "b"]
    assert pick(members=["a", "nope"]) == []
    assert pick(members=[]) == []


def test_helpers_by_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`2020` int, PIEZAS int, other int")
    assert filters.year_columns(df) == ["2020"]
    assert filters.columns_like(df, "PIEZ") == ["PIEZAS"]
    assert filters.optional_filters(df, other=3, PIEZAS=None).count() == 1
    totals = spark.createDataFrame([("a",), ("Grand Total",), ("%all%",), (None,)], "k string")
    assert rows(filters.drop_totals(totals, "k", null_is_total=True)) == [("a",)]
    assert [r[0] for r in totals.filter(filters.differs("k", "a")).collect()] == ["Grand Total", "%all%", None]


def test_dict_lookup_last_entry_wins_and_never_fans_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 1, "null")], "key string, o int, v string")
    assert rows(joins.dict_lookup(df, "k", table, "key", "v", "into", ["o"])) == [("a", "new"), ("b", None), (None, None)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k long, d string")
    assert rows(joins.lookup_join(fact, dim, ["k"], how, salts=7)) == rows(joins.lookup_join(fact, dim, ["k"], how))


def test_salting_a_full_join_is_refused(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        joins.lookup_join(df, df, ["k"], "full", salts=2)


def test_no_broadcast_hint_is_used(spark):
    """Beyond the size threshold the same join shuffles both sides."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = spark.range(10).toDF("k"), spark.range(5).toDF("k")
        plan = joins.lookup_join(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_membership_partitions_the_key_union(spark):
    left = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "k string, l int")
    right = spark.createDataFrame([("a", "x"), ("c", "y"), (None, "z")], "k string, r string")
    assert rows(quality.membership_by_key(left, right, ["k"])) == [
        ("a", 1, "x", "both"), ("b", 3, None, "left_only"), ("c", None, "y", "right_only"), (None, 4, "z", "both"),
    ]
    assert rows(quality.membership_by_row(left, right, ["k"], {"both": "B"})) == [
        ("a", 1, "B"), ("a", 2, "B"), ("b", 3, "left_only"), ("c", None, "right_only"), (None, 4, "B"),
    ]
    flipped = rows(quality.membership_by_row(left, right, ["k"], detailed_is_left=False))
    assert ("b", 3, "right_only") in flipped and ("c", None, "left_only") in flipped


def test_multi_parent_keeps_all_rows(spark):
    df = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "x"), ("q", "x"), ("r", None), ("r", "x"), (None, "x")], "c string, p string")
    marked = quality.multi_parent_check(df, "c", "p", ok="ok", warning="many")
    assert rows(marked) == sorted([
        ("p", "x", "many"), ("p", "y", "many"), ("q", "x", "ok"), ("q", "x", "ok"), ("r", None, "ok"), ("r", "x", "ok"), (None, "x", "ok"),
    ], key=str)


def test_period_membership_uses_the_global_month(spark):
    df = spark.createDataFrame(
        [(date(2024, 3, 1), "a"), (date(2024, 2, 1), "a"), (date(2024, 2, 1), "b"), (date(2024, 3, 1), "c"), (date(2024, 1, 1), "d"), (date(2024, 3, 1), None)],
        "Date date, p string",
    )
    assert rows(quality.period_membership(df, ["p"])) == [("b", "No Report"), ("c", "New Report")]


def test_unresolved(spark):
    df = spark.createDataFrame([("a", None, 2), ("a", None, 1), ("b", 1.0, 1)], "k string, r double, o int")
    assert rows(quality.unresolved_keys(df, "r", ["k"])) == [("a",)]
    assert rows(quality.first_unresolved(df, "r", ["k"], ["o"])) == [("a", None, 1)]


def test_window_refresh_is_idempotent(spark):
    master = spark.createDataFrame([(date(2024, m, 1), m) for m in range(1, 7)], "Fecha date, v int")
    latest = spark.createDataFrame([(date(2024, 5, 1), 50), (date(2024, 7, 1), 70)], "Fecha date, v int")
    once = refresh.window_refresh(master, latest)
    assert rows(once.select("v")) == rows_of(pd.DataFrame({"v": [1, 2, 3, 4, 50, 70]}))
    assert rows(refresh.window_refresh(once, latest)) == rows(once)


def test_retro_diff_needs_both_sides(spark):
    schema = "k string, v long"
    now = spark.createDataFrame([("a", 3), ("a", 2), ("b", 1), ("c", 9), (None, 1)], schema)
    before = spark.createDataFrame([("a", 4), ("b", 1), ("d", 5)], schema)
    assert rows(refresh.retro_diff(now, before, ["k"], "v")) == [("a", 5, 4, 1)]


def test_shares_sum_to_one_and_allocation(spark):
    df = spark.createDataFrame([("p", "x", 1.0), ("p", "y", 3.0), ("q", "x", 0.0)], "p string, c string, v double")
    index = shares.share_index(df, "p", "c", "v")
    assert rows(index) == [("p", "x", 0.25), ("p", "y", 0.75), ("q", "x", None)]
    assert rows(shares.share_index(df, "p", "c", "v", salts=4)) == rows(index)
    facts = spark.createDataFrame([("p", "m", 8.0), ("zz", "m", 1.0)], "p string, prod string, qty double")
    ratios = spark.createDataFrame([("p", "y", "m", 4.0)], "p string, c string, prod string, Ratio double")
    got = shares.allocate_share(facts, index, ratios, "p", "c", "prod", "qty")
    assert rows(got.select("p", "c", "Split", "`Pacientes Totales`")) == [
        ("p", "x", 2.0, None), ("p", "y", 6.0, 1.5), ("zz", None, None, None),
    ]


def test_crosstab(spark):
    sheet = [["Mes", "2023", "", "2024", ""], ["", "PIEZAS", "IMPORTE", "PIEZAS", "IMPORTE"], ["", "", "", "", ""]]
    sheet += [[str(m), str(m), f"${m},000.5", "", str(m * 10)] for m in range(1, 13)]
    df = spark.createDataFrame([("s", sheet)], "id string, rows array<array<string>>")
    long = reshape.crosstab_to_long(df, ["id"], "rows", {"Units": "PIEZAS", "MXN": "IMPORTE"}, drop_columns=1)
    got = {(r["Date"], r["Metric"]): r["Value"] for r in long.collect()}
    assert len(got) == 48
    assert got[date(2023, 2, 1), "Units"] == 2.0 and got[date(2023, 2, 1), "MXN"] == 2000.5
    assert got[date(2024, 12, 1), "Units"] is None and got[date(2024, 12, 1), "MXN"] == 120.0


def test_clean_source(spark):
    df = spark.createDataFrame([("2020", "1", "x", 1.0), ("2024", "1", "x", 2.0), ("2024", "1", "x", 3.0), ("2024", "2", "y", None)], "ANNUAL string, MES string, P string, U double")
    from cotejo.functions.dates import month_from_parts

    spec = SourceSpec(keys=["Date", "Institucion", "Product_ID"], measures=["Units"], rename={"P": "Product_ID", "U": "Units"},
                      derive={"Date": month_from_parts("ANNUAL", "MES")}, literals={"Institucion": "I"}, back=2)
    assert rows(clean_source(df, spec)) == [
        (date(2024, 1, 1), "I", "x", "Units", 5.0), (date(2024, 2, 1), "I", "y", "Units", 0.0),
    ]
