from datetime import date

from pyspark.sql import functions as F

from cotejo.operators.snapshots import LEDGER_KEY, Origin, diff_ledger, newest_slice, snapshot_diff, snapshot_totals

ORIGIN = Origin("O", {"piezas": "PIEZAS"}, site="clues", brand=None)


def tables(spark):
    live = spark.createDataFrame(
        [("2024", "1", "s1", "12.75"), ("2024", "1", "s1", None), ("2024", "2", "s1", "x"), ("2024", "10", "s2", "5"), ("2024", "1", "gone", "9")],
        "annual string, mes string, clues string, piezas string",
    )
    frozen = spark.createDataFrame(
        [("2024", "1", "s1", "12.75", "2024-05-01"), ("2024", "2", "s1", "3", "2024-05-01"), ("2024", "3", "s1", "4", "2024-05-01"), ("2024", "1", "s1", "999", "2024-04-01")],
        "annual string, mes string, clues string, piezas string, ref_frz_dt string",
    )
    sites = spark.createDataFrame([("s1", "I1"), ("s2", "I2")], "clave_clues string, institucion string")
    frozen_sites = spark.createDataFrame(
        [("s1", "I1", "2024-05-01"), ("s1", "OLD", "2024-04-01")], "clave_clues string, institucion string, ref_frz_dt string"
    )
    return live, frozen, sites, frozen_sites


def test_totals(spark):
    got = {(r["DATE"], r["INSTITUCION"]): r for r in snapshot_totals(*tables(spark), ORIGIN).collect()}
    assert set(got) == {(date(2024, 1, 1), "I1"), (date(2024, 2, 1), "I1"), (date(2024, 3, 1), "I1"), (date(2024, 10, 1), "I2")}
    equal = got[date(2024, 1, 1), "I1"]
    assert (equal["TOTAL_STANDARD"], equal["TOTAL_FREEZE"], equal["MARCA"], equal["VARIABLE"]) == (12.75, 12.75, "-", "PIEZAS")
    # The newest month is compared as a date: October is after February.
    assert (equal["DATE_STANDARD"], equal["DATE_FREEZE"]) == (date(2024, 10, 1), "2024-05-01")
    # A text that is no number counts as nothing, a group without numbers is 0.
    assert got[date(2024, 2, 1), "I1"]["TOTAL_STANDARD"] == 0.0
    only_frozen = got[date(2024, 3, 1), "I1"]
    assert only_frozen["TOTAL_STANDARD"] is None and only_frozen["DATE_STANDARD"] is None


def test_differences(spark):
    rows = {r["DATE"]: r for r in snapshot_diff(snapshot_totals(*tables(spark), ORIGIN)).collect()}
    assert set(rows) == {date(2024, 2, 1), date(2024, 3, 1), date(2024, 10, 1)}
    assert rows[date(2024, 2, 1)]["DIFF ABS"] == 3.0 and rows[date(2024, 2, 1)]["DIFF%"] is None
    assert rows[date(2024, 3, 1)]["DIFF ABS"] is None
    assert rows[date(2024, 3, 1)]["MOTIVO"] == "Un origen no tiene información"
    assert rows[date(2024, 2, 1)]["MOTIVO"] == "Sin identificar"


def test_ledger_keeps_each_difference_once_and_the_new_row(spark):
    new = snapshot_diff(snapshot_totals(*tables(spark), ORIGIN), F.lit("new"))
    old = snapshot_diff(snapshot_totals(*tables(spark), ORIGIN), F.lit("old"))
    extra = old.limit(1).withColumn("TOTAL_FREEZE", F.lit(77.0))
    merged = diff_ledger(new, old.unionByName(extra))
    assert merged.count() == new.count() + 1
    assert {r["FECHA IDENTIFICACION"] for r in merged.filter("TOTAL_FREEZE <> 77 OR TOTAL_FREEZE IS NULL").collect()} == {"new"}
    assert merged.select(*[F.col(f"`{c}`") for c in LEDGER_KEY]).distinct().count() == merged.count()


def test_newest_slice_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "frz")
    _, frozen, _, _ = tables(spark)
    frozen.write.partitionBy("ref_frz_dt").parquet(path)
    df = newest_slice(spark.read.schema(frozen.schema).parquet(path))
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref_frz_dt" in plan
