import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from cotejo.operators.filters import exclude_month
from cotejo.sources import delimited as dl
from cotejo.sources import snapshot_store as store
from cotejo.sources.sql_files import read_sql, run_sql_file


def write(path, text, encoding):
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("name,encoding,sep", [
    ("latin1", "latin-1", ";"), ("utf8", "utf-8", ";"), ("UTF-8-SIG", "utf-8-sig", ","), ("utf-16", "utf-16", "\t"),
])
def test_encodings(spark, tmp_path, name, encoding, sep):
    text = sep.join(["Año", "código", "n"]) + "\n" + sep.join(["2024", "ñ00120", "1.5"]) + "\n" + sep.join(["2023", "", "2"]) + "\n"
    path = write(tmp_path / "f.txt", text, encoding)
    schema = dl.text_schema(["Año", "código", "n"], {"n": "double"})
    df = dl.read_delimited(spark, path, schema, sep, name)
    assert sorted(map(tuple, df.collect()), key=str) == [("2023", None, 2.0), ("2024", "ñ00120", 1.5)]
    assert dl.read_delimited(spark, path, schema, sep, name, columns=["n"]).columns == ["n"]


def test_projection_reaches_the_reader(spark, tmp_path):
    path = write(tmp_path / "f.txt", "a|b|c\n1|2|3\n", "utf-8")
    df = dl.read_delimited(spark, path, dl.text_schema(["a", "b", "c"]), "|", columns=["b"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:string>" in plan
    assert df.first()[0] == "2"


def test_write_and_read_again(spark, tmp_path):
    df = spark.createDataFrame([("á", 1)], "k string, v int")
    for encoding in ("utf-16", "latin1"):
        path = str(tmp_path / encoding)
        dl.write_delimited(df, path, ";", encoding)
        schema = dl.text_schema(["k", "v"], {"v": "int"})
        assert dl.read_delimited(spark, path, schema, ";", encoding).first() == ("á", 1)


def test_folder_of_files_with_two_date_formats(spark, tmp_path):
    write(tmp_path / "A.txt", "Date|u\n20230501|1\n20230601|2\n", "utf-8")
    write(tmp_path / "B.txt", "Date|u\n2023-05-01|3\n", "utf-8")
    df = dl.read_folder(spark, str(tmp_path), dl.text_schema(["Date", "u"]))
    df = dl.unify_dates(df, "Date")
    df = exclude_month(df, "Date", 2023, 5, F.col("source_file") == "A.txt")
    assert sorted(map(tuple, df.collect())) == [(date(2023, 5, 1), "3", "B.txt"), (date(2023, 6, 1), "2", "A.txt")]


def test_named_outputs_and_missing_tables(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    paths = dl.write_outputs({"one": df, "two": df}, str(tmp_path / "out"))
    assert {os.path.basename(p) for p in paths.values()} == {"one", "two"}
    assert dl.read_or_empty(spark, paths["one"], "v int").count() == 1
    assert dl.read_or_empty(spark, str(tmp_path / "none"), "v int").count() == 0


def test_strip_marks(spark):
    assert dl.strip_marks(spark.createDataFrame([(1, 2)], ["﻿a", " b "])).columns == ["a", "b"]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    for month in range(1, 15):
        year, m = 2023 + (month - 1) // 12, (month - 1) % 12 + 1
        store.write_snapshot(spark.createDataFrame([(date(year, m, 1), month)], "Fecha date, v int"), root, "Fecha")
    again = spark.createDataFrame([(date(2024, 2, 1), 99), (date(2023, 1, 1), 98)], "Fecha date, v int")
    store.write_snapshot(again, root, "Fecha")
    df = store.read_snapshots(spark, root)
    assert df.select(store.SNAPSHOT).distinct().count() == 14
    assert sorted(r["v"] for r in store.nth_newest(df, 1).collect()) == [98, 99]
    assert [r["v"] for r in store.nth_newest(df, 2).collect()] == [13]
    assert store.nth_newest(df, 15).count() == 0
    assert store.keep_newest(df, 12).select(store.SNAPSHOT).distinct().count() == 12
    assert store.keep_newest(df, 12).agg(F.min(store.SNAPSHOT)).first()[0] == "2023-03"


def test_sql_files(spark, tmp_path):
    path = write(tmp_path / "q.sql", "select k, sum(v) as s from {t} where v > :low group by k", "utf-8")
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 7)], "k string, v int")
    assert sorted(map(tuple, run_sql_file(spark, path, {"t": df}, {"low": 2}).collect())) == [("a", 5), ("b", 7)]
    assert "union all" in read_sql("lake_deliveries.sql")
