from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cotejo.plans import public_health, regional, tenders
from cotejo.session import cut_lineage, ensure_checkpoint_dir

RUN = datetime(2024, 6, 1, 8, 30)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect()), key=str)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("202401", "PAN", "PUBLIC-health", "1", 10.0, "1,234,500"), ("202401", "PAN", "PUBLIC-health", "1", 5.0, "500,000"),
         ("202402", "PAN", "retail", "2", 1.0, "100,000"), ("202402", "XXX", "retail", "2", 1.0, "1"), ("202402", "PAN", "retail", "9", 1.0, "1")],
        "PERIOD_CD string, COUNTRY_ABV_CD string, CHANNEL_DESC string, FCC_CD string, UNITS_QTY double, LIST_VALUES_USD_AMT string",
    )


@pytest.fixture(scope="module")
def dimension(spark):
    products = spark.createDataFrame(
        [("PAN", "m1", "1", "ALPHA", "ALPHA 1X10MG"), ("PAN", "m1", "2", "beta", "BETA 5"), ("XXX", "m1", "2", "no", "no")],
        "COUNTRY_ABV_CD string, MANUFACTURER_CD string, FCC_CD string, PRODUCT_DESC string, PACK_DESC string",
    )
    makers = spark.createDataFrame([("PAN", "m1", "MAKER", "CORP")], "COUNTRY_ABV_CD string, MANUFACTURER_CD string, MANUFACTURER_DESC string, CORP_DESC string")
    molecules = spark.createDataFrame([("PAN", "1", "mol b"), ("PAN", "1", "mol a"), ("PAN", "2", "mol c")], "COUNTRY_ABV_CD string, FCC_CD string, MLCL_DESC string")
    return regional.product_dimension(products, makers, molecules, ["PAN"])


@pytest.fixture(scope="module")
def market(spark):
    return spark.createDataFrame(
        [("2024-01-01", "alpha", " alpha x ", "mol a", "alpha 1x10mg", "maker", "corp", "L01-ANTI x", "PA", "public-HEALTH", 15.0, 17.345),
         ("2024-01-01", "gamma", "alpha x", "mol z", "g", "other", "corp", "L02-Y", "PA", "retail", 2.0, 3.0),
         (None, None, None, None, None, None, None, None, None, None, 17.0, 20.0),
         ("Grand Total", None, None, None, None, None, None, None, None, None, 17.0, 20.0)],
        "Period string, `Product Description2` string, `Product Description` string, Molecule string, `Pack Description` string, "
        "`Manufacturer Description` string, `Corporation Description` string, `Atc 4` string, `Country Code` string, Channel string, "
        "Units double, `Values Usd` double",
    )


def test_historical_validation(sales, dimension, market):
    fact = regional.sales_fact(sales, dimension, ["PAN"])
    assert rows(fact, "Product", "Molecule", "Presentation", "Channel", "Metric", "Value") == [
        ("Alpha", "Mol A", "Alpha 1X10Mg", "Public-Health", "QTY", 15.0),
        ("Alpha", "Mol A", "Alpha 1X10Mg", "Public-Health", "USD", 17.34),
        ("Beta", "Mol C", "Beta 5", "Retail", "QTY", 1.0),
        ("Beta", "Mol C", "Beta 5", "Retail", "USD", 1.0),
        # A product that no dimension row describes stays, without a description.
        (None, None, None, "Retail", "QTY", 1.0),
        (None, None, None, "Retail", "USD", 0.0),
    ]
    report = regional.historical_validation(fact, regional.market_fact(market, {"PA": "PAN"}), RUN)
    got = {(r["Product"], r["Metric"]): r for r in report.collect()}
    assert got["Alpha", "QTY"]["Motivo"] == "Sin diferencias" and got["Alpha", "QTY"]["Diff %"] == 0.0
    assert got["Alpha", "USD"]["FF Value"] == 17.34
    assert got["Gamma", "QTY"]["FF Value"] is None and got["Gamma", "QTY"]["Diff Abs"] == 2.0
    assert {r["Fecha extracción"] for r in got.values()} == {"2024-06-01 08:30"}


def test_dimension_reports_on_a_checkpoint(spark, sales, dimension):
    fact = cut_lineage(regional.sales_fact(sales, dimension, ["PAN"]))
    reports = regional.dimension_reports(fact, {"product": ["Product"], "country": ["Country_ID"]})
    assert rows(reports["product"], "Product", "Status") == [("Alpha", "No Report"), ("Beta", "New Report")]
    assert reports["country"].count() == 0
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_catalogue_reports(spark, market):
    dimensional = spark.createDataFrame([("2024-01", "pack", "MOL a", "L01-anti x"), ("2024-01", "other", "mol q", "L09-Q")], "PERIOD string, PACK_DESC string, MOLECULE string, ATC4 string")
    catalogue = spark.createDataFrame([("L01-ANTI X", "onco", "hs"), ("L08-Z", "x", "y")], "`ATC IV` string, `OVERALL TA ` string, `HS/OTHER` string")
    got = regional.catalogue_reports(market, dimensional, catalogue)
    assert rows(got["class_market"], "ATC IV", "Overall TA", "Status") == [
        ("L01-Anti X", "Onco", "both"), ("L02-Y", None, "right_only"), ("L08-Z", "X", "left_only")]
    assert rows(got["class_dimension"], "ATC IV", "Presentation", "Status") == [
        ("L01-Anti X", "Pack", "both"), ("L02-Y", None, "right_only"), ("L09-Q", "Other", "left_only")]
    assert {r["Status"] for r in got["double_molecules"].collect()} == {"Más de 1 molecula asociada"}
    assert rows(got["molecule_dimension"], "Molecule", "Product", "Status") == [
        ("Mol A", "Alpha", "both"), ("Mol Q", None, "left_only"), ("Mol Z", "Gamma", "right_only")]


def test_sent_vs_market(spark, market):
    products = regional.relevant_products(
        spark.createDataFrame([("1", "ALPHA 1"), ("2", "ALPHA PLUS 2"), ("3", "nothing")], "`Product Internal Code` string, `SKU Description` string"),
        ["ALPHA", "ALPHA PLUS"], {"ALPHA PLUS 2": "ALPHA PLUS"},
    )
    assert rows(products, "Product_ID", "Product") == [("1", "Alpha"), ("2", "Alpha Plus")]
    clients = regional.client_countries(
        spark.createDataFrame([(" panama rep. ", "0000012345678"), ("nowhere", "1")], "Country string, `Client Internal Code` string"),
        {"Panama": "PA"}, {"Panama Rep.": "Panama"},
    )
    sent = spark.createDataFrame(
        [(date(2024, 1, 9), "1", "12345678", " Publico ", 7), (date(2024, 1, 20), "1", "9912345678", "Publico", 3), (date(2024, 1, 9), "3", "12345678", "x", 7), (date(2024, 1, 9), "1", "zz", "x", 7)],
        "Date date, `Product Internal Code` string, `Client Internal Code` string, `Market Type / Outlet Canal` string, `Units of SKU` int",
    )
    fact = regional.sent_fact(sent, products, clients, {"Panama": "PA"}, {"Publico": "Public-Health"})
    assert rows(fact, *regional.SENT_KEYS, "Value") == [(date(2024, 1, 1), "Alpha", "PA", "Panama", "Public-Health", 10)]
    report = regional.sent_vs_market(fact, regional.market_units(market, "maker", {"Panama": "PA"}), RUN)
    assert rows(report, "Sent Units", "Market Units", "Diff Abs", "Diff %") == [(10.0, 15.0, -5.0, 0.5)]


def test_outliers_and_forecast(sales, dimension):
    fact = regional.sales_fact(sales, dimension, ["PAN"], ["Product"])
    got = regional.outliers_and_forecast(fact)
    assert got.filter("Product = 'Alpha' AND Metric = 'QTY'").count() == 2 + 3
    assert got.filter("Product = 'Beta'").count() == 2 * (1 + 3)


def test_delivery_chain(spark):
    flat = spark.createDataFrame([("2024", "1", "120", 10.0, 100.0), ("2024", "1", "120", 5.0, 50.0), ("2019", "1", "120", 5.0, 50.0)], "ANNUAL string, MES string, CLAVE_CByCM string, PIEZAS double, IMPORTE double")
    other = spark.createDataFrame([("2024", "2", "7", 1.0, 2.0)], "ANNUAL string, MES string, CLAVE_CByCM string, `PIEZAS ALTA IMSS` double, IMPORTE double")
    ff = tenders.flat_facts([
        (flat, tenders.FlatFile("Normales", {"PIEZAS": "Units", "IMPORTE": "MXN"}, 4)),
        (other, tenders.FlatFile("IMSS", {"PIEZAS ALTA IMSS": "Units", "IMPORTE": "MXN"})),
    ])
    assert ff.count() == 4
    lake = tenders.delivery_lake_fact(spark.createDataFrame([("2024-01-01", "Normales", "120", 15.0, 151.0)], "month_date string, institucion string, product_id string, units double, amount double"))
    export = tenders.delivery_export_fact(
        spark.createDataFrame([("2024-01-01", "any", "00120", "regular", 15.0, 151.0), ("2024-01-01", "IMSS", "7", "programme", 1.0, 1.0), ("2024-01-01", "else", "7", "programme", 1.0, 1.0)],
                              "Date string, Institution string, CByCM string, `Sub Channel` string, Units double, MXN double"),
        "regular", "programme",
    )
    sheet = [["Mes", "2024", ""], ["", "PIEZAS", "IMPORTE"], ["", "", ""]] + [[str(m), str(15 if m == 1 else 0), "150"] for m in range(1, 13)]
    board = tenders.crosstab_fact(spark.createDataFrame([(sheet,)], "r array<array<string>>"), "r", "Normales", {"Units": "PIEZAS", "MXN": "IMPORTE"}, drop_columns=1)
    catalogue = spark.createDataFrame([("120", "PRINCIPLE one")], "CLAVE_CBYCM string, PRINC_ACTIVO string")
    report = tenders.chain_validation({"Board": board, "FF": ff, "Lake": lake, "Export": export}, RUN, catalogue, coarse_first=True)
    assert tuple(report.columns) == tenders.REPORT
    got = {(r["Comparativa"], r["Date"], r["Institucion"], r["Product"], r["Metric"]): r for r in report.collect()}
    jan = date(2024, 1, 1)
    assert got["Board vs FF", jan, "Normales", "Sin Identificar", "Units"]["Motivo"] == "Sin diferencias"
    assert got["FF vs Lake", jan, "Normales", "Principle One", "MXN"]["Diff Abs"] == 1.0
    assert got["Lake vs Export", jan, "Normales", "Principle One", "Units"]["Motivo"] == "Sin diferencias"
    assert got["Lake vs Export", jan, "IMSS", None, "Units"]["Value_x"] is None
    both = tenders.consolidated({"Altas": report, "Otra": report})
    assert both["unified"].count() == 2 * report.count()
    assert 0 < both["differences"].count() < both["unified"].count()


def test_awards_and_consumption(spark):
    board = spark.createDataFrame([(2024, "ENERO", "IMSS", "5", "1,234", "$1,234.50"), (2024, "enero", "no", "5", "1", "$1")],
                                  "`AÑO` int, `MES ` string, `INSTITUCIÓN` string, `CLAVE CNIS_anterior` string, PIEZAS string, IMPORTE string")
    assert rows(tenders.award_dashboard_fact(board, ["IMSS"]), "Date", "Metric", "Value") == [
        (date(2024, 1, 1), "MXN", 1234.5), (date(2024, 1, 1), "Units", 1234.0)]
    flat = spark.createDataFrame([("2024", "1", "s", "5", 1.0, 2.0), ("2024", "1", "t", "5", 1.0, 2.0)], "ANNUAL string, MES string, CLAVE_CLUES string, CLAVE_CByCM string, PIEZAS double, IMPORTE_MAX double")
    sites = spark.createDataFrame([("s", "IMSS"), ("t", "no")], "CLAVE_CLUES string, INSTITUCION string")
    assert rows(tenders.award_flat_fact(flat, sites, ["IMSS"]), "Institucion", "Metric", "Value") == [("IMSS", "MXN", 2.0), ("IMSS", "Units", 1.0)]
    var = spark.createDataFrame([("2024-01-01", "mol", 5.0), ("2019-01-01", "mol", 5.0)], "Month string, Molecule string, `CPM R` double")
    stock = spark.createDataFrame([("2024-01-01", "mol", 7.0), ("2024-01-01", "two", 8.0)], "Month string, Molecule string, Stock double")
    assert rows(tenders.consumption_export_fact(var, stock, "IMSS", "CPM R", "CPMR"), "Product", "Metric", "Value") == [
        ("Mol", "CPMR", 5.0), ("Mol", "Inventario", 7.0), ("Two", "CPMR", 0.0), ("Two", "Inventario", 8.0)]


def test_snapshot_history(spark, tmp_path):
    live = spark.createDataFrame([("2024", "1", "s", "5", "1", "1")], "annual string, mes string, clave_clues string, piezas string, importe string, precio string")
    frozen = live.withColumns({"ref_frz_dt": F.lit("2024-05-01"), "piezas": F.lit("6")})
    sites = spark.createDataFrame([("s", "I")], "clave_clues string, institucion string")
    frozen_sites = sites.withColumn("ref_frz_dt", F.lit("2024-05-01"))
    path = str(tmp_path / "ledger")
    run = lambda: tenders.snapshot_history({"ALTAS ISSSTE": (live, frozen)}, sites, frozen_sites, path, RUN)
    first = run()
    assert first["totals"].count() == 3 and first["differences"].count() == 1
    first["ledger"].write.parquet(path)
    assert run()["ledger"].count() == 1


def test_registry(spark):
    master = spark.createDataFrame([(date(2023, 1, 1), "adalimumab", "p", "e", "r", "s", 5), (date(2024, 1, 1), "Adalimumab", "p", "e", "r", "s", 5), (date(2024, 1, 1), "Adalimumab", "q", "e", "r", "s", 5)],
                                   "Fecha date, `Principio activo` string, `Problema de salud` string, Estado string, `Región de Origen` string, `Establecimiento Origen` string, `Número de registros` long")
    raw = spark.createDataFrame([("s", "p", "r", "Adalimumab", "Enero", 2024, "e", 15), ("s", "q", "r", "Adalimumab", "January", 2024, "e", 5)],
                                "`Establecimiento Origen-alias` string, `Problema de salud-alias` string, `Región de Origen-alias` string, `Principio Activo` string, Mes string, `Año` int, Estado string, `SUM(Number of Records)-alias` long")
    current = public_health.refreshed_registry(master, public_health.registry_download(raw), {"adalimumab": "Adalimumab"})
    assert current.count() == 3
    assert rows(current, "Principio activo") == [("Adalimumab",)] * 3
    changes = public_health.registry_changes(current, master, ["Adalimumab"])
    assert rows(changes, "Problema de salud", "Diferencia") == [("p", 10)]
    index = public_health.indication_shares(current, ["Adalimumab"])
    assert rows(index, "Problema de salud", "Indice") == [("p", 0.8), ("q", 0.2)]


def test_purchases(spark):
    index = spark.createDataFrame([("Rituximab", "p", 0.5), ("Rituximab", "q", 0.5)], "`Principio activo` string, `Problema de salud` string, Indice double")
    sites = spark.createDataFrame([("hospital a", "Site A")], "CENABAST string, FONASA string")
    regions = spark.createDataFrame([("town", "North")], "Comuna string, Region string")
    bought = spark.createDataFrame([(2024, 1, "RITUXIMAB 500", " Fonasa ", "HOSPITAL A", "TOWN", "box", 10.0), (2024, 1, "rituximab", None, "hospital b", "x", "vial", 6.0), (2024, 1, "other", "x", "y", "z", "w", 1.0)],
                                   "anio int, Mes int, NombreGenerico string, Origen string, NombreDestinatario string, ComunaDestinatario string, Denominacion string, CantidadDespacho double")
    ratios = spark.createDataFrame([("Rituximab", "p", "box", 3.0)], "`Principio activo` string, `Problema de salud` string, Denominacion string, Ratio double")
    got = public_health.purchases_v1(bought, index, ratios, sites, regions, ["Rituximab"])
    assert rows(got["patients"], "Problema de salud", "Region", "Establecimiento destino", "Pacientes Totales", "Origen") == [
        ("p", "North", "Site A", 1.67, "Otros"), ("p", None, None, None, "Otros"), ("q", "North", "Site A", None, "Otros"), ("q", None, None, None, "Otros")]
    assert rows(got["open_sites"], "NombreDestinatario") == [("hospital b",)]
    assert rows(got["open_ratios"], "Denominacion") == [("box",), ("vial",)]
    later = spark.createDataFrame([("2024", "1.0", "Ley Ricarte Soto", "HOSPITAL A", "RITUXIMAB", "brand", "R", 9.0), ("2024", "1", "other", "HOSPITAL A", "RITUXIMAB", "brand", "R", 9.0)],
                                  "`Año` string, Mes string, `Nombre canal de distribución` string, `Nombre cliente destinatario` string, `Nombre producto genérico` string, `Nombre producto comercial` string, `Nombre región` string, `Cantidad de pedido` double")
    ratios = ratios.withColumnsRenamed({"Denominacion": "Nombre producto comercial"}).withColumn("Nombre producto comercial", F.lit("brand"))
    got = public_health.purchases_v2(later, index, ratios, sites, ["rituximab"])
    assert rows(got["patients"], "Fecha", "Problema de salud", "Pacientes Totales") == [(date(2024, 1, 1), "p", 1.5), (date(2024, 1, 1), "q", None)]
    assert rows(got["open_ratios"], "Problema de salud") == [("q",)]


def test_every_origin_has_a_name_of_its_own():
    assert len({o.name for o in tenders.ORIGINS}) == 7


def test_registry_out_of_payloads(spark):
    import json

    def part(*positions):
        return {"tupleIds": [], "valueIndices": [], "aliasIndices": list(positions)}

    captions = ["Establecimiento Origen", "Problema de salud", "Región de Origen", "SUM(Number of Records)"]
    panes = {
        "paneColumnsList": [{"vizPaneColumns": [part(0, 3, 0), part(1, 1, 3), part(2, 2, 2), part(-5, -6, -5)]}],
        "vizDataColumns": [{"fieldCaption": c, "dataType": "cstring", "paneIndices": [0], "columnIndices": [i]} for i, c in enumerate(captions)],
    }
    words = ["site", "problem", "region", "%all%", "1,234", "99"]
    payload = json.dumps({"secondaryInfo": {"presModelMap": {
        "vizData": {"presModelHolder": {"genPresModelMapPresModel": {"presModelMap": {"W": {"presModelHolder": {"genVizDataPresModel": {"paneColumnsData": panes}}}}}}},
        "dataDictionary": {"presModelHolder": {"genDataDictionaryPresModel": {"dataSegments": {"0": {"dataColumns": [{"dataType": "cstring", "dataValues": words}]}}}}}}}})
    df = spark.createDataFrame([("Rituximab", "Activo", "enero 2024", payload)], "`Principio Activo` string, Estado string, period string, payload string")
    got = public_health.registry_download(public_health.registry_from_payloads(df, "W"))
    assert [tuple(r) for r in got.collect()] == [(date(2024, 1, 1), "Rituximab", "problem", "Activo", "region", "site", 1234)]


def test_consumption_chain_by_product_name(spark):
    lake = spark.createDataFrame([("2024-01-01", "IMSS", "1", 5.0, 7.0), ("2024-01-01", "IMSS", "2", 1.0, 2.0), ("2024-01-01", "IMSS", "3", 1.0, 2.0)],
                                 "month_date string, institucion string, product_id string, stock double, consumption double")
    fact = tenders.consumption_lake_fact(lake, {"IMSS": "CPMR"})
    catalogue = spark.createDataFrame([("1", "same"), ("2", "SAME")], "CLAVE_CBYCM string, PRINC_ACTIVO string")
    named = tenders.by_product_name(fact, catalogue)
    assert rows(named, "Product", "Metric", "Value") == [("Same", "CPMR", 9.0), ("Same", "Inventario", 6.0)]
    board = named.withColumn("Product", F.lit(tenders.NO_PRODUCT_NAME))
    report = tenders.chain_validation({"Board": board, "FF": named, "Lake": named}, RUN, product="Product", coarse_first=True)
    assert {r["Motivo"] for r in report.collect()} == {"Sin diferencias"} and report.count() == 4


def test_purchases_with_salts(spark):
    index = spark.createDataFrame([("Rituximab", "p", 1.0)], "`Principio activo` string, `Problema de salud` string, Indice double")
    sites = spark.createDataFrame([("a", "A")], "CENABAST string, FONASA string")
    ratios = spark.createDataFrame([("Rituximab", "p", "b", 2.0)], "`Principio activo` string, `Problema de salud` string, `Nombre producto comercial` string, Ratio double")
    bought = spark.range(50).select(
        F.lit("2024").alias("Año"), F.lit("1").alias("Mes"), F.lit("Ley Ricarte Soto").alias("Nombre canal de distribución"),
        F.lit("A").alias("Nombre cliente destinatario"), F.lit("rituximab").alias("Nombre producto genérico"), F.lit("b").alias("Nombre producto comercial"),
        F.lit("r").alias("Nombre región"), F.col("id").cast("double").alias("Cantidad de pedido"))
    plain = public_health.purchases_v2(bought, index, ratios, sites, ["rituximab"])
    salted = public_health.purchases_v2(bought, index, ratios, sites, ["rituximab"], salts=8)
    assert rows(salted["patients"], "Establecimiento destino", "Pacientes Totales") == rows(plain["patients"], "Establecimiento destino", "Pacientes Totales")
