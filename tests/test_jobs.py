"""Whole runs: what they write, repeat and remove."""

from datetime import date, datetime

import pytest

from cotejo.operators.snapshots import LEDGER_SCHEMA, diff_ledger, snapshot_diff, snapshot_totals
from cotejo.plans import jobs
from cotejo.plans.public_health import MEASURE, REGISTRY
from cotejo.sources import storage
from cotejo.sources.month_table import MonthTable
from test_snapshots import ORIGIN, tables

RUN_AT = datetime(2024, 6, 1, 12, 0)


def test_history(spark, tmp_path):
    live, frozen, sites, frozen_sites = tables(spark)
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    run = lambda number, live: jobs.run_history({"O": (live, frozen)}, sites, frozen_sites, out, ledger, number, RUN_AT, [ORIGIN])
    paths = run(1, live)
    totals = snapshot_totals(live, frozen, sites, frozen_sites, ORIGIN)
    key = lambda df: sorted(map(str, df.drop("FECHA IDENTIFICACION").collect()))
    assert key(spark.read.parquet(paths["totals"])) == key(totals)
    assert key(spark.read.parquet(paths["differences"])) == key(snapshot_diff(totals))
    table = MonthTable(spark, ledger, spark.createDataFrame([], LEDGER_SCHEMA).schema, "DATE")
    first = key(table.read())
    assert first == key(snapshot_diff(totals))
    # A changed February adds a difference; the others are found again and stay single.
    changed = live.unionByName(spark.createDataFrame([("2024", "2", "s1", "7")], live.schema))
    for _ in range(2):
        run(2, changed)
        again = snapshot_diff(snapshot_totals(changed, frozen, sites, frozen_sites, ORIGIN))
        assert key(table.read()) == key(diff_ledger(again, snapshot_diff(totals)))
    assert len(key(table.read())) == len(first) + 1


def test_a_known_freeze_needs_no_search(spark):
    live, frozen, sites, frozen_sites = tables(spark)
    found, given = (snapshot_totals(live, frozen, sites, frozen_sites, ORIGIN, freeze=f) for f in (None, "2024-05-01"))
    assert sorted(map(str, found.collect())) == sorted(map(str, given.collect()))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (found, given)]
    assert plans[1].count("Subquery") < plans[0].count("Subquery")


def test_chain(spark, tmp_path):
    fact = lambda rows: spark.createDataFrame(rows, "Date date, Institucion string, Product_ID string, Metric string, Value double")
    month = date(2024, 1, 1)
    sources = {"A": fact([(month, "I", "1", "Units", 5.0)]), "B": fact([(month, "I", "1", "Units", 5.0)]), "C": fact([(month, "I", "1", "Units", 4.0)])}
    catalogue = spark.createDataFrame([("1", "ALGO")], "CLAVE_CBYCM string, PRINC_ACTIVO string")
    report = jobs.run_chain(sources, str(tmp_path / "chain"), RUN_AT, catalogue)
    assert {r["Comparativa"]: r["Diff Abs"] for r in report.collect()} == {"A vs B": 0.0, "B vs C": 1.0}
    assert storage.finished(spark, str(tmp_path / "chain"))


def registry(spark, rows):
    full = [(date.fromisoformat(d), i, p, "E", "R", "S", n) for d, i, p, n in rows]
    return spark.createDataFrame(full, ", ".join(f"`{c}` {'date' if c == 'Fecha' else 'long' if c == MEASURE else 'string'}" for c in REGISTRY))


def test_registry(spark, tmp_path):
    root, out = str(tmp_path / "registry"), str(tmp_path / "out")
    run = lambda number, rows: jobs.run_registry(registry(spark, rows), root, out, number, ["Drug"], {"drug": "Drug"}, keep=2)
    run(1, [("2024-01-01", "Drug", "P", 1), ("2024-02-01", "Drug", "P", 2), ("2024-03-01", "drug", "Q", 3)])
    paths = run(2, [("2024-02-01", "Drug", "P", 5), ("2024-03-01", "Drug", "Q", 3), ("2024-04-01", "Drug", "Q", 1)])
    changes = spark.read.parquet(paths["changes"]).collect()
    assert [(str(r.Fecha), r["Registros ultimo mes"], r["Registros mes anterior"], r["Diferencia"]) for r in changes] == [("2024-02-01", 5, 2, 3)]
    shares = {r["Problema de salud"]: r["Indice"] for r in spark.read.parquet(paths["shares"]).collect()}
    assert shares == pytest.approx({"P": 0.6, "Q": 0.4})
    table = MonthTable(spark, root, jobs.REGISTRY_SCHEMA, "Fecha")
    assert table.manifest() == {"2024-01": 1, "2024-02": 2, "2024-03": 2, "2024-04": 2}
    run(3, [("2024-04-01", "Drug", "Q", 2)])
    run(4, [("2024-04-01", "Drug", "Q", 4)])
    # Months that the kept versions name stay, whichever version wrote them.
    assert table.versions() == [3, 4] and sum(r[MEASURE] for r in table.read().collect()) == 1 + 5 + 3 + 4
    assert storage.partitions(spark, f"{root}/version=1", "month") == ["2024-01"]
    assert storage.partitions(spark, f"{root}/version=2", "month") == ["2024-02", "2024-03"]
