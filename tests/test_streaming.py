from datetime import date

from cotejo.streaming.incremental import ledger_stream, read_newest, refresh_stream

SCHEMA = "Fecha date, v int"


def deliver(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_deliveries_replace_the_trailing_window(spark, tmp_path):
    files, root, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    deliver(spark, files, [(date(2024, m, 1), m) for m in (1, 2, 3)])
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(files)
    refresh_stream(stream(), root, check).awaitTermination(120)
    deliver(spark, files, [(date(2024, 3, 1), 30), (date(2024, 4, 1), 40)])
    refresh_stream(stream(), root, check).awaitTermination(120)
    table = lambda: sorted(r["v"] for r in read_newest(spark, root, SCHEMA).collect())
    assert table() == [1, 2, 30, 40]
    refresh_stream(stream(), root, check).awaitTermination(120)
    assert table() == [1, 2, 30, 40]


def test_ledger_grows_by_new_differences_only(spark, tmp_path):
    files, root, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    deliver(spark, files, [(date(2024, 1, 1), 1), (date(2024, 2, 1), 2)])
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(files)
    ledger_stream(stream(), root, check, ["Fecha", "v"]).awaitTermination(120)
    deliver(spark, files, [(date(2024, 2, 1), 2), (date(2024, 2, 1), 3)])
    ledger_stream(stream(), root, check, ["Fecha", "v"]).awaitTermination(120)
    assert read_newest(spark, root, SCHEMA).count() == 3


def test_missing_table_is_empty(spark, tmp_path):
    assert read_newest(spark, str(tmp_path / "no"), SCHEMA).count() == 0
