import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cotejo.operators import reconcile as rc

SCHEMA = "k string, m string, Value double"
LEFT = [("a", "u", 10.0), ("b", "u", 0.0), ("c", "u", -5.0), ("d", "u", 0.125), ("e", "u", 7.0), (None, "u", 1.0), ("z", "u", None)]
RIGHT = [("a", "u", 12.0), ("b", "u", 3.0), ("d", "u", 0.12), ("e", "u", 7.0), ("f", "u", -2.0), (None, "u", 4.0), ("g", "u", 0.0), ("z", "u", 2.0)]


def pandas_reconcile(left, right, mode):
    """The same by a pandas outer merge of grouped frames."""
    grouped = []
    for rows in (left, right):
        frame = pd.DataFrame(rows, columns=["k", "m", "Value"])
        grouped.append(frame.groupby(["k", "m"], dropna=False)["Value"].sum().reset_index())
    df = pd.merge(*grouped, on=["k", "m"], how="outer")
    if mode == "rounded":
        df[["Value_x", "Value_y"]] = df[["Value_x", "Value_y"]].round(2)
    x, y = df["Value_x"], df["Value_y"]
    both = x.notna() & y.notna()
    difference = x - y if mode == "signed" else (x - y).abs()
    df["Diff Abs"] = np.where(both, difference, df[["Value_x", "Value_y"]].max(axis=1))
    base, other = (y, x) if mode == "rounded" else (x, y)
    with np.errstate(all="ignore"):
        df["Diff %"] = np.where(base == 0, -1, np.where(both, other / base - 1, -1))
    df["Motivo"] = np.where(~both, "Un origen no tiene información",
                            np.where(df["Diff Abs"] == 0, "Sin diferencias", "Sin identificar"))
    return df


def as_set(rows):
    return {tuple(None if v is None or v != v else v for v in row) for row in rows}


@pytest.mark.parametrize("mode", ["abs", "signed", "rounded"])
def test_modes_equal_an_outer_merge(spark, mode):
    ours = rc.reconcile(spark.createDataFrame(LEFT, SCHEMA), spark.createDataFrame(RIGHT, SCHEMA), ["k", "m"], mode)
    theirs = pandas_reconcile(LEFT, RIGHT, mode)
    assert as_set(tuple(r) for r in ours.collect()) == as_set(
        tuple(r) for r in theirs[ours.columns].astype(object).itertuples(index=False)
    )
    assert ours.count() == len({k for k, *_ in LEFT + RIGHT})


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        rc.add_differences(spark.createDataFrame([(1.0, 2.0)], "Value_x double, Value_y double"), "x")


def test_one_shuffle_for_any_number_of_sources(spark):
    frames = {n: spark.createDataFrame(LEFT, SCHEMA) for n in "ABCD"}
    plan = rc.reconcile_chain(frames, ["k", "m"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_chain_equals_its_pairs(spark):
    frames = {
        "A": spark.createDataFrame(LEFT, SCHEMA),
        "B": spark.createDataFrame(RIGHT, SCHEMA),
        "C": spark.createDataFrame(LEFT[:3] + [("q", "u", 1.0)], SCHEMA),
    }
    chain = rc.reconcile_chain(frames, ["k", "m"])
    single = None
    for a, b in itertools.pairwise(frames):
        one = rc.reconcile(frames[a], frames[b], ["k", "m"], "rounded").withColumn("Comparativa", F.lit(f"{a} vs {b}"))
        single = one if single is None else single.unionByName(one)
    assert as_set(map(tuple, chain.select(*single.columns).collect())) == as_set(map(tuple, single.collect()))


def test_rollup_sums_the_fine_side(spark):
    coarse = spark.createDataFrame([("jan", "-1", 10.0), ("feb", "-1", 4.0)], "k string, p string, Value double")
    fine = spark.createDataFrame(
        [("jan", "1", 4.0), ("jan", "2", 6.0), ("mar", "1", 5.0)], "k string, p string, Value double"
    )
    rows = {r["k"]: r for r in rc.reconcile_rollup(coarse, fine, ["k"], carry=["p"]).collect()}
    assert (rows["jan"]["Value_x"], rows["jan"]["Value_y"], rows["jan"]["p"]) == (10.0, 10.0, "-1")
    assert rows["jan"]["Motivo"] == "Sin diferencias"
    assert rows["feb"]["Value_y"] is None and rows["feb"]["Diff Abs"] == 4.0
    assert rows["mar"]["Value_x"] is None and rows["mar"]["p"] is None and rows["mar"]["Diff %"] == -1.0


def test_keep_differences_keeps_null_reason(spark):
    df = spark.createDataFrame([("Sin diferencias",), ("x",), (None,)], "Motivo string")
    assert {r[0] for r in rc.keep_differences(df).collect()} == {"x", None}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows: one row per task is shuffled, the sums are whole."""
    rows = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("u").alias("m"),
        F.lit(1.0).alias("Value"),
    )
    result = rc.reconcile(rows, rows.filter("k = 'hot'"), ["k", "m"])
    assert result.filter("k = 'hot'").select("Value_x", "Value_y").first() == (133333.0, 133333.0)
    assert result.count() == 66_668
