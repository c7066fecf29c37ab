"""Tables of which a change replaces only some months: what is written, read and removed."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.operators.snapshots import diff_ledger, extend_ledger
from cotejo.sources import snapshot_store as store
from cotejo.sources import storage
from cotejo.sources.month_table import MonthTable

SCHEMA = T.StructType([T.StructField("Fecha", T.DateType()), T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def day(text):
    return None if text is None else date.fromisoformat(text)


def frame(spark, rows):
    return spark.createDataFrame([(day(d), k, v) for d, k, v in rows], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return MonthTable(spark, str(tmp_path / "t"), SCHEMA, "Fecha")


def rows(table):
    return sorted((str(r.Fecha), r.k, r.v) for r in table.read().collect())


def test_window_replaces_from_its_first_day(spark, table):
    table.replace_window(frame(spark, [("2024-01-05", "a", 1), ("2024-02-03", "a", 2), ("2024-02-20", "a", 3), ("2024-03-01", "a", 4), (None, "a", 5)]), 1)
    table.replace_window(frame(spark, [("2024-02-10", "b", 6), ("2024-04-01", "b", 7), (None, "b", 8)]), 2)
    assert rows(table) == [("2024-01-05", "a", 1), ("2024-02-03", "a", 2), ("2024-02-10", "b", 6), ("2024-04-01", "b", 7), ("None", "b", 8)]
    assert table.manifest() == {"2024-01": 1, "2024-02": 2, "2024-04": 2, "none": 2}
    table.replace_window(frame(spark, []), 3)
    assert len(rows(table)) == 5 and table.versions() == [1, 2, 3]


def test_an_empty_table(spark, table):
    assert rows(table) == [] and table.versions() == [] and table.remove_unused() == []


def test_bytes_written_follow_the_delivery(spark, table):
    years = spark.range(200_000).select(
        F.expr("date_add(date '2000-01-01', cast(id % 7300 as int))").alias("Fecha"), F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("v")
    )
    table.replace_window(years, 1)
    table.replace_window(years.filter("Fecha >= date '2019-11-01'"), 2)
    sizes = [storage.total_bytes(spark, f"{table.root}/version={v}") for v in (1, 2)]
    assert sizes[1] < sizes[0] / 40
    assert table.read().count() == 200_000 and set(table.manifest().values()) == {1, 2}


def test_a_repeated_version_changes_nothing(spark, table):
    table.replace_window(frame(spark, [("2024-01-01", "a", 1), ("2024-02-01", "a", 2)]), 1)
    second = frame(spark, [("2024-02-01", "b", 3)])
    first_try = frame(spark, [("2024-02-01", "lost", 9), ("2024-09-01", "lost", 9)])
    table.replace_window(first_try, 2)  # a try whose months the next one lacks
    for _ in range(2):
        table.replace_window(second, 2)
        assert rows(table) == [("2024-01-01", "a", 1), ("2024-02-01", "b", 3)]


def test_an_uncommitted_version_is_not_seen(spark, table):
    table.replace_window(frame(spark, [("2024-01-01", "a", 1)]), 1)
    frame(spark, [("2024-01-01", "x", 9)]).withColumn("month", F.lit("2024-01")).write.partitionBy("month").parquet(f"{table.root}/version=2")
    assert rows(table) == [("2024-01-01", "a", 1)] and table.versions() == [1]


def test_unused_folders_go(spark, table):
    for version, months in ((1, (1, 2, 3)), (2, (2, 3)), (3, (3,)), (4, (3,))):
        table.replace_window(frame(spark, [(f"2024-0{m}-01", f"v{version}", m) for m in months]), version)
    before = rows(table)
    gone = table.remove_unused(keep=2)
    assert {g.split("/t/")[1] for g in gone} == {"version=1/month=2024-02", "version=1/month=2024-03", "version=2/month=2024-03"}
    assert rows(table) == before and table.versions() == [3, 4]
    assert storage.partitions(spark, f"{table.root}/version=1", "month") == ["2024-01"]


KEYS = ["Fecha", "k"]


def test_ledger_reads_only_the_months_of_a_batch(spark, table):
    merge = lambda old, new: extend_ledger(new, old, KEYS)
    table.merge_months(frame(spark, [("2024-01-01", "a", 1), ("2024-02-01", None, 2), ("2024-02-01", "b", 3)]), 1, merge)
    seen = []

    def watched(old, new):
        seen.extend(old.inputFiles())
        return merge(old, new)

    table.merge_months(frame(spark, [("2024-02-01", None, 20), ("2024-02-01", "c", 4), ("2024-02-01", "c", 5), ("2024-05-01", "d", 6)]), 2, watched)
    assert seen and all("month=2024-02" in f for f in seen)
    got = sorted((str(r.Fecha), str(r.k), r.v) for r in table.read().collect())
    assert got == [("2024-01-01", "a", 1), ("2024-02-01", "None", 20), ("2024-02-01", "b", 3), ("2024-02-01", "c", 4), ("2024-05-01", "d", 6)]


def test_ledger_forms_agree_and_do_not_sort_the_ledger(spark):
    ledger = frame(spark, [("2024-01-01", None, 1), ("2024-01-01", "a", 2), ("2024-02-01", "b", 3)])
    new = frame(spark, [("2024-01-01", None, 9), ("2024-02-01", "b", 3), ("2024-02-01", "c", 8), ("2024-02-01", "c", 7)])
    both = [sorted(map(str, f(new, ledger, KEYS).collect())) for f in (diff_ledger, extend_ledger)]
    assert both[0] == both[1]
    plan = extend_ledger(new, ledger, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("SortAggregate") <= 2


def test_retention_removes_folders(spark, tmp_path):
    root = str(tmp_path / "snap")
    for month in range(1, 7):
        df = spark.createDataFrame([(date(2024, month, 1), month)], "Fecha date, v int")
        gone = store.write_snapshot(df, root, "Fecha", keep=4)
        assert gone == ([f"2024-{month - 4:02d}"] if month > 4 else [])
    assert store.snapshot_months(spark, root) == [f"2024-{m:02d}" for m in (3, 4, 5, 6)]
    assert sorted(r.v for r in store.read_snapshots(spark, root).collect()) == [3, 4, 5, 6]
    assert [r.v for r in store.read_nth_newest(spark, root, 2).collect()] == [5]
    assert store.read_nth_newest(spark, root, 9).collect() == []
    (one,) = store.read_snapshots(spark, root, ["2024-04"]).inputFiles()
    assert "snapshot_month=2024-04" in one
