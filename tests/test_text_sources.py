"""Text that arrives in odd shapes: references, quotes, headers, statements for a remote database."""

import csv
import html
import html.entities
import json
import io
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cotejo.functions import markup
from cotejo.functions.markup import unescape
from cotejo.operators import joins, reconcile
from cotejo.sources import delimited as dl
from cotejo.sources import sql_files as sq
from cotejo.sources.payload_text import text_to_table


def test_references_as_the_standard_library_reads_them(values):
    texts = [
        "", "plain", "&", "&&amp;&", "a &lt;b&gt; c", "&eacute;&Eacute;&eacute", "&#233;&#xE9;&#XE9;&#233x", "&amp;eacute;", "&notit; &notin;",
        "&nosuch; &nosuch", "&#0;&#x0;&#00065;", "&#128;&#150;&#x99;&#129;", "&#55296;&#x10FFFD;&#x110000;&#9999999;", "&#x1F600; &hearts;&nbsp;|",
        "&quot;&#34;&apos;&#39;", "x&copyy &copy2", "&#; &#x; &;", "&ampamp;&ltlt", "é &#x6f22;&#28450; &NotEqualTilde;",
    ]
    assert values(texts, unescape("c")) == [html.unescape(t) for t in texts]
    assert values([None], unescape("c")) == [None]


def test_random_references(values):
    rng = random.Random(2)
    parts = ["&", "#", "x", ";", "amp", "eacute", "38", "65", "e9", " ", "lt", "not", "X", "0", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(12)) for _ in range(300)]
    texts = [t for t in texts if not any(c in html.unescape(t) for c in "\x0e\x0b")]
    got = values(texts, unescape("c"))
    # Control signs are dropped by the standard library; browsers keep them.
    same = [g == html.unescape(t) for g, t in zip(got, texts) if "�" not in html.unescape(t) or "�" in g]
    assert all(same) and len(same) > 250


def table_of(spark, text, columns, sep=","):
    df = spark.createDataFrame([(1, text)], "i int, t string")
    return [tuple(r)[2:] for r in text_to_table(df, ["i"], "t", columns, sep).orderBy("row_no").collect()]


def test_stray_quotes_do_not_join_lines(spark):
    assert table_of(spark, 'name,kind\n5" pipe,a\n6" pipe,b\n7" x,c\n', ["name", "kind"]) == [('5" pipe', "a"), ('6" pipe', "b"), ('7" x', "c")]


def test_quotes_open_only_at_the_start_of_a_cell(spark):
    text = 'a,b,c\n"x\ny",5" z,"q ""r"" s"\r\n"cut" off,"",w\n\n \t \n1,"un,closed\nto the end'
    assert table_of(spark, text, ["a", "b", "c"]) == [("x\ny", '5" z', 'q "r" s'), ("cut off", None, "w"), ("1", "un,closed\nto the end", None)]


def test_text_with_another_separator_and_old_line_ends(spark):
    assert table_of(spark, 'a|b\r"x|y"|2\r3|"', ["b", "a"], "|") == [("2", "x|y"), (None, "3")]
    assert table_of(spark, "", ["a"]) == [] and table_of(spark, "a,b", ["a"]) == []


def test_random_tables_as_the_csv_module_reads_them(spark):
    rng = random.Random(4)
    cells = ['', "x", '5" y', 'say "hi"', "a,b", "line\nbreak", "cr\rlf", '"', "é 漢", ' "lead']
    for n in range(12):
        rows = [[f"c{i}" for i in range(4)]] + [[rng.choice(cells) for _ in range(4)] for _ in range(15)]
        out = io.StringIO()
        csv.writer(out, lineterminator=("\n", "\r\n")[n % 2], quoting=(csv.QUOTE_MINIMAL, csv.QUOTE_ALL)[n // 2 % 2]).writerows(rows)
        want = [tuple(c or None for c in r) for r in rows[1:] if any(c.strip(" \t") for c in r) or n // 2 % 2 or True]
        got = table_of(spark, out.getvalue(), rows[0])
        assert got == want


def test_a_wide_header_and_a_long_quoted_cell(spark):
    names = [f"column {i}" for i in range(3000)]
    text = ",".join(names) + "\n" + ",".join(f'"{i}, ""q"""' for i in range(3000)) + '\n"' + '""' * 50_000 + '"\n'
    got = table_of(spark, text, [names[2999], names[0], names[1500]])
    assert got[0] == ('2999, "q"', '0, "q"', '1500, "q"') and got[1] == (None, '"' * 50_000, None)


def test_folder_with_two_layouts(spark, tmp_path):
    files = {"a.txt": "Año|u|v\n2024|1|x\n", "b.txt": "v|more|Año\ny|?|2023\nz|?|2022\n", "c.txt": 'u|"Año"\n7|2021\n', "d.txt": "", "_hidden": "no|such\n1|2\n"}
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode("latin-1"))
    df = dl.read_folder(spark, str(tmp_path), dl.text_schema(["Año", "u", "v"], {"u": "int"}), "|", "latin1")
    assert sorted(map(tuple, df.collect())) == [("2021", 7, None, "c.txt"), ("2022", None, "z", "b.txt"), ("2023", None, "y", "b.txt"), ("2024", 1, "x", "a.txt")]


def test_layouts_are_found_without_a_job(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"f{i}.txt").write_bytes(("﻿a;b\n1;2\n" if i % 2 else "b;a\n3;4\n").encode("utf-8"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("layouts", "")
    df = dl.read_folder(spark, str(tmp_path), dl.text_schema(["a", "b"]), ";")
    jobs = len(tracker.getJobIdsForGroup("layouts"))
    spark.sparkContext.setJobGroup("rest", "")
    assert jobs == 0 and df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert df.groupBy("a", "b").count().collect().__len__() == 2
    empty = dl.read_folder(spark, str(tmp_path / "none"), dl.text_schema(["a"]))
    assert empty.columns == ["a", "source_file"] and empty.count() == 0


@pytest.mark.parametrize("encoding,python", [("utf-16", "utf-16"), ("utf8", "utf-8")])
def test_folder_encodings(spark, tmp_path, encoding, python):
    (tmp_path / "a.txt").write_bytes("ñ|b\n1|é\n".encode(python))
    (tmp_path / "b.txt").write_bytes("b|ñ\nü|2\n".encode(python))
    df = dl.read_folder(spark, str(tmp_path), dl.text_schema(["ñ", "b"]), "|", encoding)
    assert sorted(map(tuple, df.collect())) == [("1", "é", "a.txt"), ("2", "ü", "b.txt")]


def test_rendered_statement():
    text = "select ':no', \"{no}\", a::int -- :no {no}\nfrom {t} where k = :k and d >= :d and x in (select * from {t});"
    got = sq.render_sql(text, {"t": 'db."My Table"'}, {"k": "it's", "d": date(2024, 2, 1)})
    assert got == "select ':no', \"{no}\", a::int -- :no {no}\nfrom db.\"My Table\" where k = 'it''s' and d >= DATE '2024-02-01' and x in (select * from db.\"My Table\")"


def test_literals():
    assert [sq.literal(v) for v in (None, True, 3, 2.5, Decimal("1.10"), ["a", 1], datetime(2024, 1, 2, 3, 4, 5))] == [
        "NULL", "TRUE", "3", "2.5", "1.10", "ARRAY['a', 1]", "TIMESTAMP '2024-01-02 03:04:05'"
    ]
    for wrong in (float("nan"), object()):
        with pytest.raises((ValueError, TypeError)):
            sq.literal(wrong)


def test_wrong_names_are_errors():
    with pytest.raises(ValueError, match="not a table name"):
        sq.render_sql("select * from {t}", {"t": "t; drop table x"}, {})
    with pytest.raises(KeyError):
        sq.render_sql("select :a", {}, {})
    with pytest.raises(ValueError, match="not in the statement: b"):
        sq.render_sql("select :a", {}, {"a": 1, "b": 2})


@pytest.mark.parametrize("name,tables,args", [
    ("lake_awards.sql", {"awards": "l.awards", "sites": "l.sites"}, {"years": 2, "institutions": ["A", "B"]}),
    ("lake_deliveries.sql", {"frozen_deliveries": "l.f", "first_programme": "l.a", "second_programme": "l.b"}, {"regular_years": 4, "programme_years": 2}),
    ("lake_consumption.sql", {"first_table": "l.a", "second_table": "l.b", "third_table": "l.c"}, {"years": 4}),
])
def test_stored_statements_render_whole(name, tables, args):
    text = sq.plan_lake_read(sq.read_sql(name), tables, args).table
    assert "{" not in text and not any(f":{a}" in text for a in args) and all(t in text for t in tables.values())


def test_months_are_cut_into_ranges(spark):
    conditions = sq.month_predicates("month_date", date(2023, 11, 5), date(2024, 4, 30), 2)
    plan = sq.plan_lake_read("select * from {t}", {"t": "x"}, predicates=conditions)
    assert len(plan.statements()) == 4 and plan.statements()[0].startswith("SELECT * FROM (select * from x\n) q WHERE month_date >= '2023-11-01' AND month_date < '2024-01-01'")
    days = [f"{y}-{m:02d}-01" for y in (2022, 2023, 2024) for m in range(1, 13)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "month_date string")
    # Every row is in one range, with or without a date.
    assert sum(df.filter(c).count() for c in conditions) == len(days)
    assert df.filter(conditions[2]).count() == 2
    assert sq.LakeRead("t").statements() == ["SELECT * FROM t"]


def test_salted_join_of_a_row_that_stands_very_often(spark):
    fact = spark.range(45_003).select(F.lit("k").alias("k"), F.lit(1).alias("v")).unionByName(spark.createDataFrame([("k", 2), (None, 3)], "k string, v int"))
    dim = spark.createDataFrame([("k", "n"), ("k", "m")], "k string, name string")
    got = {tuple(r[:2]): r[2] for r in joins.lookup_join(fact, dim, ["k"], salts=4).groupBy("v", "name").count().collect()}
    assert got == {(1, "n"): 45_003, (1, "m"): 45_003, (2, "n"): 1, (2, "m"): 1, (3, None): 1}
    counts = spark.createDataFrame([(1, 1), (2, 10_000), (3, 10_001), (4, 20_000), (5, 25_000)], "i int, n long")
    assert {tuple(r) for r in joins._unfold(counts, "n").groupBy("i").count().collect()} == {(1, 1), (2, 10_000), (3, 10_001), (4, 20_000), (5, 25_000)}


def test_two_decimal_types_meet_in_the_wider_one(spark):
    left = spark.createDataFrame([("a", Decimal("0.1"))] * 3, "k string, Value decimal(18,2)")
    right = spark.createDataFrame([("a", Decimal("0.300000"))], "k string, Value decimal(28,6)")
    (row,) = reconcile.reconcile(left, right, ["k"]).collect()
    assert row["Motivo"] == reconcile.Labels().equal
    assert reconcile.common_type([f.dataType for f in spark.createDataFrame([], "a decimal(18,2), b decimal(28,6), c int").schema]) == "decimal(28,6)"
    assert reconcile.common_type([f.dataType for f in spark.createDataFrame([], "a decimal(38,0), b decimal(38,30)").schema]) == "double"
    assert reconcile.common_type([f.dataType for f in spark.createDataFrame([], "a double, b int").schema]) == "double"


def test_names_lie_in_small_maps(values):
    buckets = json.loads(markup._named()[0])
    assert sum(map(len, buckets)) == len(html.entities.html5) and max(map(len, buckets)) <= 16
    names = [f"&{n}" for n in html.entities.html5]
    assert values(names, unescape("c")) == [html.unescape(n) for n in names]
