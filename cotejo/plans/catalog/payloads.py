"""Dashboard payloads. Each is built by Spark from one row of a table, so that there are as
many payloads as rows, and decoded again."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotejo.functions.arrays import spread, spread_structs
from cotejo.operators import dashboard, worksheets
from cotejo.plans.catalog import query, table
from cotejo.sources.payload_text import text_to_table

_NO_INDICES = "array<int>"


def _indices(column=None):
    return (column if column is not None else F.array()).cast(_NO_INDICES)


def _cell(values=None, aliases=None, tuples=None):
    return F.struct(
        _indices(tuples).alias("tupleIds"),
        _indices(values).alias("valueIndices"),
        _indices(aliases).alias("aliasIndices"),
    )


def _descriptor(caption, data_type, column, fn=None, selected=None):
    return F.struct(
        F.lit(caption).cast("string").alias("fieldCaption"),
        F.lit(data_type).alias("dataType"),
        F.lit(fn).cast("string").alias("fn"),
        F.lit(selected).cast("boolean").alias("isAutoSelect"),
        F.array(F.lit(0)).alias("paneIndices"),
        F.array(F.lit(column)).alias("columnIndices"),
    )


def _segment(*columns):
    return F.struct(
        F.array(
            *[F.struct(F.lit(t).alias("dataType"), v.alias("dataValues")) for t, v in columns]
        ).alias("dataColumns")
    )


def _nested(value, *path):
    for name in reversed(path):
        value = F.struct(value.alias(name))
    return value


def _document_parts(spark, folder):
    """Documents as worksheets: one row per line, values by position in the distinct lines.

    Texts: the distinct lines, language, source; numbers: the distinct line lengths. The
    lines are spread over two segments.
    """
    documents = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.split("text", "\n").alias("lines")
    )
    lengths = F.transform("lines", lambda line: F.length(line).cast("string"))
    staged = documents.withColumns(
        {"words": F.array_distinct("lines"), "lengths": lengths, "numbers": F.array_distinct(lengths)}
    )
    found = lambda values, v: F.array_position(values, v).cast("int") - 1
    return staged.withColumns(
        {
            "line_index": F.transform("lines", lambda line: found("words", line)),
            "length_index": F.transform("lengths", lambda n: found("numbers", n)),
        }
    )


def _panes():
    words = F.size("words")
    kind = F.transform(
        "lines", lambda _, i: F.when(i % 2 == 0, -(words + 1)).otherwise(-(words + 2))
    )
    beyond = F.concat(F.array(F.lit(1_000_000_000)), F.slice("line_index", 2, F.greatest(F.size("lines") - 1, F.lit(0))))
    cells = F.array(
        _cell(values=F.col("line_index"), tuples=F.transform("lines", lambda _, i: i + 1)),
        _cell(values=F.col("length_index")),
        _cell(aliases=kind),
        _cell(values=F.col("line_index")),
        _cell(values=F.col("length_index")),
        _cell(values=beyond),
        _cell(values=F.col("line_index")),
    )
    columns = F.array(
        _descriptor("Line", "cstring", 0, selected=True),
        _descriptor("Length", "real", 1),
        _descriptor("Kind", "cstring", 2),
        _descriptor("Copy", "date", 3),
        _descriptor("Line", "real", 4, fn="ATTR"),
        _descriptor("Tail", "cstring", 5),
        _descriptor(None, "cstring", 6, fn="[system:visual].[tuple_id]"),
    )
    return F.struct(
        F.array(F.struct(cells.alias("vizPaneColumns"))).alias("paneColumnsList"),
        columns.alias("vizDataColumns"),
    )


def _head_panes():
    """A second worksheet: language and source beside the length of the first line."""
    words = F.size("words")
    cells = F.array(
        _cell(aliases=F.array(-(words + 1), -(words + 2))),
        _cell(values=F.array(F.lit(0))),
    )
    columns = F.array(_descriptor("Part", "cstring", 0), _descriptor("Size", "real", 1))
    return F.struct(
        F.array(F.struct(cells.alias("vizPaneColumns"))).alias("paneColumnsList"), columns.alias("vizDataColumns")
    )


def _segments():
    half = (F.size("words") / 2).cast("int")
    first = F.slice("words", 1, half)
    rest = F.concat(
        F.slice("words", half + 1, F.size("words") - half), F.array("lang", "source")
    )
    return F.struct(
        _segment(("cstring", first), ("real", F.col("numbers"))).alias("0"),
        _segment(("cstring", rest)).alias("1"),
    )


def _documents(spark, folder):
    data = F.struct(
        F.struct(
            F.struct(
                _nested(
                    F.struct(
                        _nested(_panes(), "presModelHolder", "genVizDataPresModel", "paneColumnsData").alias("[LINES]"),
                        _nested(F.struct(F.lit(1).alias("x")), "presModelHolder", "genVizDataPresModel").alias("[EMPTY]"),
                        _nested(_head_panes(), "presModelHolder", "genVizDataPresModel", "paneColumnsData").alias("[HEAD]"),
                    ),
                    "presModelHolder",
                    "genPresModelMapPresModel",
                    "presModelMap",
                ).alias("vizData"),
                _nested(_segments(), "presModelHolder", "genDataDictionaryPresModel", "dataSegments").alias("dataDictionary"),
            ).alias("presModelMap")
        ).alias("secondaryInfo")
    )
    return _document_parts(spark, folder).select("doc_id", F.to_json(data).alias("payload"))


_LINES = """
    l AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents),
    e AS (SELECT doc_id, lang, source, lines, unnest(range(len(lines))) AS i FROM l)
"""

DECODED = ["Line-value", "Length-value", "Kind-alias", "Copy-value", "Line-ATTR-value", "Tail-value"]


@query(
    "decode_payload",
    f"""
    WITH {_LINES}
    SELECT doc_id, CAST(i AS INTEGER) AS row_no, lines[i + 1] AS "Line-value",
           CAST(length(lines[i + 1]) AS VARCHAR) AS "Length-value",
           CASE WHEN i % 2 = 0 THEN lang ELSE source END AS "Kind-alias",
           lines[i + 1] AS "Copy-value",
           CAST(length(lines[i + 1]) AS VARCHAR) AS "Line-ATTR-value",
           CASE WHEN i + 2 <= len(lines) THEN lines[i + 2] ELSE '0' END AS "Tail-value"
    FROM e
    """,
)
def decode_payload(spark, folder):
    return dashboard.decode_worksheet(_documents(spark, folder), ["doc_id"], "payload", "[LINES]", DECODED)


@query(
    "decode_response",
    f"""
    WITH {_LINES}
    SELECT doc_id, CAST(i AS INTEGER) AS row_no, lines[i + 1] AS "Line-value",
           CASE WHEN i % 2 = 0 THEN lang ELSE source END AS "Kind-alias"
    FROM e
    """,
)
def decode_response(spark, folder):
    """The same as answer to a command; the first segment is already known to the session."""
    parts = _document_parts(spark, folder)
    zone = F.struct(
        F.lit("[LINES]").alias("worksheet"),
        _nested(_panes(), "presModelHolder", "visual", "vizData", "paneColumnsData")["presModelHolder"].alias("presModelHolder"),
    )
    segments = _segments()
    stale = _segment(("cstring", F.array(F.lit("stale"))))
    response = _nested(
        F.struct(
            _nested(F.struct(stale.alias("0"), segments["1"].alias("1")), "dataSegments").alias("dataDictionary"),
            _nested(F.struct(zone.alias("7")), "dashboardPresModel", "zones").alias("workbookPresModel"),
        ),
        "vqlCmdResponse",
        "layoutStatus",
        "applicationPresModel",
    )
    sent = parts.select(
        "doc_id",
        F.to_json(response).alias("payload"),
        F.create_map(F.lit("0"), segments["0"]).alias("persisted"),
    )
    return dashboard.decode_response(
        sent, ["doc_id"], "payload", "[LINES]", ["Line-value", "Kind-alias"], persisted="persisted"
    )


@query(
    "decode_download",
    """
    SELECT p_partkey, CAST(0 AS INTEGER) AS row_no, p_name AS "Name-value", CAST(p_size AS VARCHAR) AS "Size-value",
           p_brand AS "Brand-alias"
    FROM part
    """,
)
def decode_download(spark, folder):
    """Answers to a download command as JSON text: flat positions beside a dictionary, whose
    first segment the session knows already."""
    parts = table(spark, folder, "part")

    def flat(caption, data_type, values=None, aliases=None):
        return F.struct(
            F.lit(caption).cast("string").alias("fieldCaption"),
            _indices(values).alias("valueIndices"),
            _indices(aliases).alias("aliasIndices"),
            F.lit(data_type).alias("dataType"),
            F.lit("").alias("fn"),
        )

    one = F.array(F.lit(0))
    known = _segment(("cstring", F.array("p_name", "p_brand")))
    stale = _segment(("cstring", F.array(F.lit("stale"))))
    sizes = _segment(("integer", F.array(F.col("p_size").cast("string"))))
    answer = F.struct(
        F.struct(_nested(F.struct(stale.alias("0"), sizes.alias("1")), "dataSegments").alias("dataDictionary"),
                 F.array(
                     flat("Name", "cstring", one),
                     flat("Size", "integer", one),
                     flat("Brand", "integer", None, F.array(F.lit(-2))),
                     flat(None, "cstring", one),
                 ).alias("underlyingDataTableColumns")).alias("underlyingDataTable")
    )
    body = _nested(F.array(_nested(answer, "commandReturn")), "vqlCmdResponse", "cmdResultList")
    sent = parts.select(
        "p_partkey", F.to_json(body).alias("payload"), F.create_map(F.lit("0"), known).alias("persisted")
    )
    return worksheets.decode_download(
        sent, ["p_partkey"], "payload", ["Name-value", "Size-value", "Brand-alias"], persisted="persisted"
    )


_CELLS = """
    c(column_no, "column") AS (VALUES (0, 'Line-value'), (1, 'Length-value'), (2, 'Kind-alias'),
        (3, 'Copy-value'), (4, 'Line-ATTR-value'), (5, 'Tail-value'))
"""


@query(
    "decode_all",
    f"""
    WITH {_LINES}, {_CELLS}
    SELECT doc_id, '[LINES]' AS worksheet, CAST(i AS INTEGER) AS row_no, column_no, "column",
           CASE WHEN column_no IN (0, 3) THEN lines[i + 1]
                WHEN column_no IN (1, 4) THEN CAST(length(lines[i + 1]) AS VARCHAR)
                WHEN column_no = 2 THEN CASE WHEN i % 2 = 0 THEN lang ELSE source END
                WHEN i + 2 <= len(lines) THEN lines[i + 2] ELSE '0' END AS value
    FROM e, c
    UNION ALL
    SELECT doc_id, '[HEAD]', r, 0, 'Part-alias', CASE WHEN r = 0 THEN lang ELSE source END
    FROM l, (VALUES (0), (1)) AS t(r)
    UNION ALL
    SELECT doc_id, '[HEAD]', r, 1, 'Size-value', CASE WHEN r = 0 THEN CAST(length(lines[1]) AS VARCHAR) ELSE '0' END
    FROM l, (VALUES (0), (1)) AS t(r)
    """,
)
def decode_all(spark, folder):
    """Every column of every worksheet, none of them named here."""
    opened = worksheets.open_payloads(_documents(spark, folder), ["doc_id"], "payload")
    return worksheets.decode_all(opened, ["doc_id"]).drop("sheet_no")


@query(
    "selectable_items",
    f"""
    WITH {_LINES}
    SELECT doc_id, '[LINES]' AS worksheet, 0 AS column_no, 'Line' AS "column", array_to_string(lines, '|') AS "values" FROM l
    UNION ALL SELECT doc_id, '[LINES]', 1, 'Length', array_to_string(list_transform(lines, lambda x: CAST(length(x) AS VARCHAR)), '|') FROM l
    UNION ALL SELECT doc_id, '[LINES]', 2, 'Kind',
        array_to_string(list_transform(range(len(lines)), lambda i: CASE WHEN i % 2 = 0 THEN lang ELSE source END), '|') FROM l
    UNION ALL SELECT doc_id, '[LINES]', 3, 'Copy', array_to_string(lines, '|') FROM l
    UNION ALL SELECT doc_id, '[LINES]', 4, 'Line', array_to_string(list_transform(lines, lambda x: CAST(length(x) AS VARCHAR)), '|') FROM l
    UNION ALL SELECT doc_id, '[LINES]', 5, 'Tail', array_to_string(lines[2:], '|') FROM l
    UNION ALL SELECT doc_id, '[HEAD]', 0, 'Part', lang || '|' || source FROM l
    UNION ALL SELECT doc_id, '[HEAD]', 1, 'Size', CAST(length(lines[1]) AS VARCHAR) FROM l
    """,
)
def selectable_items(spark, folder):
    opened = worksheets.open_payloads(_documents(spark, folder), ["doc_id"], "payload")
    items = worksheets.selectable_items(opened, ["doc_id"]).drop("sheet_no")
    return items.withColumn("values", F.array_join("values", "|"))


def _session_responses(spark, folder):
    """Customers as sessions, their orders as responses: each sends one of three segments and a
    null one, a zone that is always there, and one that comes and goes; zones lack data at times."""
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    values = F.array(F.concat("o_orderpriority", F.lit("/"), key), F.concat("o_orderstatus", F.lit("/"), key))
    segments = F.create_map(
        (F.col("o_orderkey") % 3).cast("string"), _segment(("cstring", values)),
        F.lit("n"), F.lit(None).cast("struct<dataColumns: array<struct<dataType: string, dataValues: array<string>>>>"),
    )

    def visual(name, shown, with_data, *cells):
        columns = F.array(*[_descriptor(c, "cstring", i) for i, (c, _) in enumerate(cells)])
        panes = F.struct(
            F.array(F.struct(F.array(*[cell for _, cell in cells]).alias("vizPaneColumns"))).alias("paneColumnsList"),
            columns.alias("vizDataColumns"),
        )
        data = F.when(with_data, F.struct(panes.alias("paneColumnsData")))
        holder = F.struct(F.struct(F.struct(data.alias("vizData"), F.lit("[]").alias("filtersJson")).alias("visual")).alias("presModelHolder"))
        return F.when(shown, F.struct(F.lit(name).alias("worksheet"), holder["presModelHolder"].alias("presModelHolder")))

    own = F.array((F.lit(-1) - F.col("o_orderkey") % 2).cast("int"))
    zones = F.struct(
        visual("Items", F.lit(True), F.col("o_orderstatus") != "F",
               ("Item", _cell(values=F.array(*map(F.lit, (3, 0, 5, 1))))), ("Own", _cell(aliases=own))).alias("1"),
        visual("Urgent", F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey") % 2 == 0,
               ("Own", _cell(aliases=own, values=F.array(F.lit(2))))).alias("2"),
    )
    response = _nested(
        F.struct(
            _nested(segments, "dataSegments").alias("dataDictionary"),
            _nested(zones, "dashboardPresModel", "zones").alias("workbookPresModel"),
        ),
        "vqlCmdResponse", "layoutStatus", "applicationPresModel",
    )
    return orders.select(F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("step"), F.to_json(response).alias("payload"))


@query(
    "session_decode",
    """
    WITH o AS (SELECT o_custkey AS session, o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p,
                      lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before,
                      max(o_orderkey) OVER (PARTITION BY o_custkey) AS last_k FROM orders),
    d AS (SELECT session, flatten(list([p || '/' || CAST(k AS VARCHAR), s || '/' || CAST(k AS VARCHAR)] ORDER BY first_k)) AS words
          FROM (SELECT session, k % 3 AS g, min(k) AS first_k, max(k) AS k, arg_max(p, k) AS p, arg_max(s, k) AS s
                FROM o GROUP BY 1, 2) GROUP BY 1),
    a AS (SELECT session, max(k) AS k FROM o WHERE s <> 'F' GROUP BY 1),
    u AS (SELECT *, coalesce(lag(k) OVER (PARTITION BY session ORDER BY k) <> before, true) AS appears
          FROM o WHERE p <> '1-URGENT'),
    r AS (SELECT *, sum(CAST(appears AS INTEGER)) OVER (PARTITION BY session ORDER BY k) AS run FROM u),
    b AS (SELECT session, max(k) FILTER (WHERE k % 2 = 0) AS k
          FROM (SELECT *, max(run) OVER (PARTITION BY session) AS last_run FROM r) WHERE run = last_run
          GROUP BY 1 HAVING max(k) = max(last_k) AND max(k) FILTER (WHERE k % 2 = 0) IS NOT NULL),
    i AS (SELECT session, k, words, list_filter([4, 1, 6, 2], lambda x: x <= len(words)) AS places FROM a JOIN d USING (session))
    SELECT session, 'Items' AS worksheet, CAST(n AS INTEGER) AS row_no, 0 AS column_no, 'Item-value' AS "column", words[places[n + 1]] AS value
    FROM (SELECT *, unnest(range(len(places))) AS n FROM i)
    UNION ALL
    SELECT session, 'Items', CAST(n AS INTEGER), 1, 'Own-alias', CASE WHEN n = 0 THEN words[1 + k % 2] ELSE '0' END
    FROM (SELECT *, unnest(range(len(places))) AS n FROM i)
    UNION ALL SELECT session, 'Urgent', 0, 0, 'Own-value', CASE WHEN len(words) > 2 THEN words[3] ELSE '0' END FROM b JOIN d USING (session)
    UNION ALL SELECT session, 'Urgent', 0, 1, 'Own-alias', words[1 + k % 2] FROM b JOIN d USING (session)
    """,
)
def session_decode(spark, folder):
    """Worksheets as sessions show them after their last response."""
    opened = worksheets.open_sessions(_session_responses(spark, folder), ["session"], "step", "payload")
    return worksheets.decode_all(opened, ["session"]).drop("sheet_no")


@query(
    "value_dictionary",
    """
    WITH l AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents),
    d AS (SELECT doc_id, 'cstring' AS data_type, len(list_distinct(lines)) + 2 AS n FROM l
          UNION ALL
          SELECT doc_id, 'real', len(list_distinct(list_transform(lines, lambda x: length(x)))) FROM l)
    SELECT doc_id, data_type, CAST(n AS INTEGER) AS entries FROM d
    """,
)
def value_dictionary(spark, folder):
    parsed = _documents(spark, folder).select("doc_id", dashboard.parse_data("payload").alias("d"))
    dictionary = dashboard.value_dictionary(dashboard.data_segments(F.col("d")))
    return spread(parsed, ["doc_id"], dictionary, "data_type", "entries").withColumn("entries", F.size("entries"))


@query(
    "column_descriptors",
    """
    WITH l AS (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n FROM documents),
    c(column_no, caption, data_type, fn, is_alias) AS (VALUES
        (0, 'Line', 'cstring', '', 0), (1, 'Length', 'real', '', 0), (2, 'Kind', 'cstring', '', 1),
        (3, 'Copy', 'date', '', 0), (4, 'Line', 'real', 'ATTR', 0), (5, 'Tail', 'cstring', '', 0))
    SELECT doc_id, caption, data_type, fn, 0 AS pane, column_no,
           CASE WHEN is_alias = 1 THEN 0 ELSE n END AS value_positions,
           CASE WHEN is_alias = 1 THEN n ELSE 0 END AS alias_positions,
           column_no = 0 AS auto_select
    FROM l, c
    """,
)
def column_descriptors(spark, folder):
    parsed = _documents(spark, folder).select("doc_id", dashboard.parse_data("payload").alias("d"))
    parsed = parsed.select("doc_id", dashboard.worksheet_panes(F.col("d"), "[LINES]").alias("panes"))
    panes = F.col("panes")
    selected = F.transform(
        dashboard.descriptors(panes, auto_select_only=True), lambda c: c["columnIndices"]
    )
    described = spread_structs(parsed, ["doc_id", selected.alias("selected")], dashboard.descriptors(panes))
    return described.select(
        "doc_id",
        F.col("fieldCaption").alias("caption"),
        F.col("dataType").alias("data_type"),
        "fn",
        F.col("paneIndices").alias("pane"),
        F.col("columnIndices").alias("column_no"),
        F.size("valueIndices").alias("value_positions"),
        F.size("aliasIndices").alias("alias_positions"),
        F.array_contains("selected", F.col("columnIndices")).alias("auto_select"),
    )


@query(
    "split_payload",
    """
    SELECT o_orderkey, o_orderpriority AS sheet, CAST(o_custkey AS VARCHAR) AS customer,
           CAST(o_orderkey AS VARCHAR) AS order_text
    FROM orders
    """,
)
def split_payload(spark, folder):
    """Raw bodies of two documents, taken apart again."""
    info = F.to_json(F.struct(F.col("o_orderpriority").alias("sheetName"), F.struct("o_custkey").alias("a")))
    data = F.to_json(F.struct(F.struct("o_orderkey").alias("b")))
    body = F.concat(
        F.length(info).cast("string"), F.lit(";"), info, F.length(data).cast("string"), F.lit(";"), data
    )
    parts = table(spark, folder, "orders").select("o_orderkey", dashboard.split_body(body).alias("p"))
    return parts.select(
        "o_orderkey",
        F.get_json_object("p.info", "$.sheetName").alias("sheet"),
        F.get_json_object("p.info", "$.a.o_custkey").alias("customer"),
        F.get_json_object("p.data", "$.b.o_orderkey").alias("order_text"),
    )


def _customer_info(spark, folder):
    """A workbook description per customer: sheets, a null zone, worksheets with and without
    data, a parameter, a filter with a quick filter, and story navigation."""
    customers = table(spark, folder, "customer")
    member = lambda c, s: F.struct(
        F.array(F.struct(c.alias("v"))).alias("t"), s.alias("s")
    )
    rich = F.col("c_acctbal") >= 0
    filters = F.to_json(
        F.array(
            F.struct(
                F.when(F.col("c_nationkey") == 3, F.lit(True)).alias("all"),
                F.struct(
                    F.array(
                        F.struct(
                            F.lit("Segment").alias("caption"),
                            F.array(F.lit("src"), F.lit("segment")).alias("name"),
                            F.lit(0).alias("ordinal"),
                        )
                    ).alias("schema"),
                    F.array(member(F.col("c_mktsegment"), rich), member(F.lit("OTHER"), ~rich)).alias("tuples"),
                ).alias("table"),
            )
        )
    )
    visual = lambda v: F.struct(F.struct(v.alias("visual")).alias("presModelHolder"))
    empty = F.struct(F.struct(F.array().cast("array<int>").alias("x")).alias("vizData"), filters.alias("filtersJson"))
    zones = F.struct(
        F.struct(F.col("c_name").alias("worksheet"), visual(empty)["presModelHolder"].alias("presModelHolder")).alias("1"),
        F.struct(
            F.when(rich, F.col("c_mktsegment")).alias("worksheet"),
            visual(F.struct(F.lit("{}").alias("other")))["presModelHolder"].alias("presModelHolder"),
        ).alias("2"),
        F.lit(None).cast("struct<worksheet: string>").alias("3"),
        _nested(
            F.struct(
                F.lit("Nation").alias("fieldCaption"),
                F.array(F.col("c_nationkey").cast("string"), F.lit("25")).alias("formattedValues"),
                F.lit("[Parameters].[nation]").alias("parameterName"),
            ),
            "presModelHolder",
            "parameterControl",
        ).alias("4"),
        F.struct(
            F.col("c_name").alias("worksheet"),
            _nested(
                F.struct(F.lit("[src].[segment]").alias("fn"), F.array(F.lit("Segment")).alias("columnFullNames")),
                "quickFilterDisplay", "quickFilter", "categoricalFilter",
            ).alias("presModelHolder"),
        ).alias("5"),
        _nested(
            F.array(
                F.struct(F.lit(1).alias("storyPointId"), F.col("c_mktsegment").alias("storyPointCaption")),
                F.struct(F.lit(2).alias("storyPointId"), F.lit("End").alias("storyPointCaption")),
            ),
            "presModelHolder", "flipboardNav", "storypointNavItems",
        ).alias("6"),
    )
    info = F.struct(
        F.col("c_name").alias("sheetName"),
        _nested(
            F.struct(
                F.array(
                    F.struct(F.col("c_mktsegment").alias("sheet"), rich.alias("isDashboard"), F.lit(True).alias("isVisible"),
                             F.array("c_name", "c_mktsegment").alias("namesOfSubsheets"), F.col("c_custkey").cast("string").alias("windowId"))
                ).alias("sheetsInfo"),
                _nested(zones, "zones").alias("dashboardPresModel"),
            ),
            "applicationPresModel", "workbookPresModel",
        ).alias("worldUpdate"),
    )
    raw = customers.select("c_custkey", F.to_json(info).alias("info"))
    parsed = raw.select("c_custkey", dashboard.parse_info("info").alias("info"))
    return parsed.withColumn("zones", dashboard.info_zones(F.col("info")))


@query(
    "list_zones",
    """
    SELECT c_custkey, '1' AS zone, c_name AS worksheet, true AS with_data FROM customer
    UNION ALL SELECT c_custkey, '2', c_mktsegment, false FROM customer WHERE c_acctbal >= 0
    """,
)
def list_zones(spark, folder):
    info = _customer_info(spark, folder)
    filled = dashboard.zone_worksheets(F.col("zones"), with_data=True)
    kept = info.withColumn("filled", filled)
    listed = dashboard.list_zones(kept, ["c_custkey", "filled"], "zones")
    return listed.select(
        "c_custkey", "zone", "worksheet", F.array_contains("filled", F.col("worksheet")).alias("with_data")
    )


@query(
    "list_sheets",
    """
    SELECT c_custkey, c_mktsegment AS sheet, c_acctbal >= 0 AS "isDashboard", true AS "isVisible",
           c_name || '|' || c_mktsegment AS "namesOfSubsheets", CAST(c_custkey AS VARCHAR) AS "windowId"
    FROM customer
    """,
)
def list_sheets(spark, folder):
    sheets = dashboard.list_sheets(_customer_info(spark, folder), ["c_custkey"], "info")
    return sheets.withColumn("namesOfSubsheets", F.array_join("namesOfSubsheets", "|"))


@query(
    "list_story_points",
    """
    SELECT c_custkey, c_name AS "storyBoard", 0 AS board, 1 AS "storyPointId", c_mktsegment AS "storyPointCaption" FROM customer
    UNION ALL SELECT c_custkey, c_name, 0, 2, 'End' FROM customer
    """,
)
def list_story_points(spark, folder):
    return dashboard.list_story_points(_customer_info(spark, folder), ["c_custkey"], "info")


@query(
    "parameter_catalogue",
    """
    SELECT c_custkey, 'Nation' AS "column", '[Parameters].[nation]' AS "parameterName",
           CAST(c_nationkey AS VARCHAR) || '|25' AS "values"
    FROM customer
    """,
)
def parameter_catalogue(spark, folder):
    found = dashboard.parameter_catalogue(_customer_info(spark, folder), ["c_custkey"], "zones")
    return found.withColumn("values", F.array_join("values", "|"))


@query(
    "filter_catalogue",
    """
    SELECT c_custkey, c_name AS worksheet, 'Segment' AS "column", 0 AS ordinal,
           c_mktsegment || '|OTHER' AS "values", '[src].[segment]' AS "globalFieldName",
           CASE WHEN c_nationkey = 3 THEN c_mktsegment || '|OTHER|all'
                WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'OTHER' END AS selection,
           1 AS quick_filters
    FROM customer
    """,
)
def filter_catalogue(spark, folder):
    found = dashboard.filter_catalogue(_customer_info(spark, folder), ["c_custkey"], "zones")
    return found.select(
        "c_custkey",
        "worksheet",
        "column",
        "ordinal",
        F.array_join("values", "|").alias("values"),
        "globalFieldName",
        F.array_join("selection", "|").alias("selection"),
        F.size("selectionAlt").alias("quick_filters"),
    )


_STATES = """
    o AS (SELECT o_custkey AS session, o_orderpriority AS key,
                 CASE WHEN min(o_orderstatus) <> 'F' THEN min(o_orderstatus) END AS value,
                 count(*) > 1 AS has_data
          FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2),
    n AS (SELECT o_custkey AS session, o_orderpriority AS key,
                 CASE WHEN min(o_orderstatus) <> 'O' THEN min(o_orderstatus) || '2' END AS value,
                 count(*) > 1 AS has_data
          FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2),
    j AS (SELECT coalesce(o.session, n.session) AS session, coalesce(o.key, n.key) AS key,
                 o.session IS NOT NULL AS has_old, n.session IS NOT NULL AS has_new,
                 o.value AS ov, n.value AS nv, n.has_data AS nd
          FROM o FULL JOIN n ON o.session = n.session AND o.key = n.key)
"""


@query(
    "state_merge",
    f"""
    WITH {_STATES}
    SELECT 'segments' AS policy, session, key, coalesce(nv, ov) AS value FROM j WHERE has_old OR nv IS NOT NULL
    UNION ALL SELECT 'parameters', session, key, CASE WHEN has_old THEN ov ELSE nv END FROM j
    UNION ALL SELECT 'filters', session, key, CASE WHEN has_new THEN nv ELSE ov END FROM j
    UNION ALL SELECT 'zones', session, key, CASE WHEN has_old AND NOT nd THEN ov ELSE nv END FROM j WHERE nv IS NOT NULL
    """,
)
def state_merge(spark, folder):
    """Sessions are customers, keys are priorities; the old state is from before 1999."""
    orders = table(spark, folder, "orders")
    border = F.lit("1999-01-01").cast("timestamp_ntz")

    def state(rows, hidden, mark):
        status = F.min("o_orderstatus")
        return rows.groupBy(F.col("o_custkey").alias("session"), F.col("o_orderpriority").alias("key")).agg(
            F.when(status != hidden, F.concat(status, F.lit(mark))).alias("value"),
            (F.count("*") > 1).alias("has_data"),
        )

    old = state(orders.filter(F.col("o_orderdate") < border), "F", "")
    new = state(orders.filter(F.col("o_orderdate") >= border), "O", "2")
    merged = None
    for policy in ("segments", "parameters", "filters", "zones"):
        one = dashboard.merge_state(old, new, ["session", "key"], policy).select(
            F.lit(policy).alias("policy"), "session", "key", "value"
        )
        merged = one if merged is None else merged.unionByName(one)
    return merged


@query(
    "value_position",
    """
    WITH l AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id, CAST(list_position(lines, lines[-1]) AS INTEGER) AS position,
           CAST(list_position(lines, lines[-1]) * 10 AS INTEGER) AS tuple_id,
           CAST(NULL AS INTEGER) AS missing
    FROM l
    """,
)
def value_position(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    wanted = F.element_at("lines", -1)
    short = F.slice(F.transform("lines", lambda _, i: i), 1, F.size("lines") - 1)
    tuples = F.array(short, F.transform("lines", lambda _, i: (i + 1) * 10))
    return documents.select(
        "doc_id",
        dashboard.value_position("lines", wanted).alias("position"),
        dashboard.value_position("lines", wanted, tuples).alias("tuple_id"),
        dashboard.value_position("lines", F.lit("\u0000")).alias("missing"),
    )


@query(
    "html_params",
    r"""
    WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
                      unnest(list_distinct(regexp_extract_all(html, '<a\b[^>]*\bhref="([^"]*)"[^>]*>', 1))) AS href
               FROM pages)
    SELECT page_id, replace(nullif(title, ''), '&amp;', '&') AS title, href AS name, href AS value FROM t
    """,
)
def html_params(spark, folder):
    """Attributes of tags out of whole pages, the title beside them."""
    pages = table(spark, folder, "pages").withColumn("title", dashboard.html_text_of("html", "title"))
    linked = dashboard.with_html_attributes(pages, "html", "a", "href", "href", "links")
    return spread(linked, ["page_id", "title"], "links", "name", "value")


@query(
    "payload_csv",
    """
    SELECT c_custkey, CAST(0 AS INTEGER) AS row_no, c_name || ', ' || c_mktsegment AS name, 'n' || CAST(c_nationkey AS VARCHAR) AS nation
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT c_custkey, 1, 'He said "' || c_mktsegment || '"', NULL FROM customer WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def payload_csv(spark, folder):
    """CSV bodies with quotes and separators in cells; an empty body gives no rows."""
    body = F.concat(
        F.lit('nation,skipped,name\nn'), F.col("c_nationkey").cast("string"), F.lit(',1,"'),
        F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('"\n,2,"He said ""'), F.col("c_mktsegment"),
        F.lit('"""\n'),
    )
    bodies = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(body).alias("body")
    )
    return text_to_table(bodies, ["c_custkey"], "body", ["name", "nation"])


_WIDE = 60


@query(
    "payload_csv_wide",
    f"""
    WITH p AS (SELECT p_partkey, p_name, p_brand, p_size FROM part)
    SELECT p_partkey, CAST(0 AS INTEGER) AS row_no, CAST(p_size AS VARCHAR) || '" ' || p_name AS "size",
           p_brand || chr(10) || p_name AS note, 'w{_WIDE - 1}' || CAST(p_partkey AS VARCHAR) AS last FROM p
    UNION ALL SELECT p_partkey, 1, 'say "' || p_brand || '", twice', '"', NULL FROM p
    UNION ALL SELECT p_partkey, 2, p_name || ' 5"', 'cut off', 'x"y"z' FROM p
    """,
)
def payload_csv_wide(spark, folder):
    """Wide CSV bodies with quotes inside plain cells, line breaks and separators inside quoted
    ones, text after a closing quote, short lines and blank lines."""
    parts = table(spark, folder, "part")
    fill = [f"c{i}" for i in range(_WIDE)]
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")

    def line(first, note, cells):
        return F.concat_ws(",", first, note, *cells)

    lines = F.concat_ws(
        "\n",
        F.lit(",".join(["size", "note", *fill, "last"])),
        line(F.concat(size, F.lit('" '), "p_name"), F.concat(F.lit('"'), "p_brand", F.lit("\n"), "p_name", F.lit('"')),
             [*[F.lit("")] * _WIDE, F.concat(F.lit(f"w{_WIDE - 1}"), key)]),
        F.lit("  "),
        line(F.concat(F.lit('"say ""'), "p_brand", F.lit('"", twice"')), F.lit('""""'), [F.lit("short")]),
        line(F.concat("p_name", F.lit(' 5"')), F.lit('"cut" off'), [*[F.lit("v")] * _WIDE, F.lit('x"y"z')]),
        F.lit(""),
    )
    return text_to_table(parts.select("p_partkey", lines.alias("body")), ["p_partkey"], "body", ["size", "note", "last"])


@query(
    "html_config",
    """
    SELECT c_custkey, c_name AS sheet, 'Año "' || c_mktsegment || '" <é> & 漢' AS title,
           'https://host/' || CAST(c_nationkey AS VARCHAR) || '/' AS host_url, '&eacute;' AS literal
    FROM customer
    """,
)
def html_config(spark, folder):
    """Configuration of a view out of its page: a JSON text in a text area, and parameter tags,
    both with named and numeric character references."""
    config = F.concat(
        F.lit("{&quot;sheetId&#34;:&#x22;"), "c_name",
        F.lit("&quot;, &quot;title&QUOT;: &quot;A&ntilde;o \\&quot;"), "c_mktsegment",
        F.lit("\\&#34; &lt;&eacute;&GT; &#38 &#x6F22;&quot;, &quot;literal&quot;: &quot;&amp;eacute;&quot;}"),
    )
    page = F.concat(
        F.lit('<html><div class="tableauPlaceholder"><param name="host&#95;url" value="https%3A&#x2F;&sol;host&#47;'),
        F.col("c_nationkey").cast("string"),
        F.lit('%2F"></div><textarea rows=1 id="tsConfigContainer">'), config, F.lit("</textarea></html>"),
    )
    pages = table(spark, folder, "customer").select("c_custkey", page.alias("html"))
    pages = pages.withColumn("config", dashboard.html_text_of("html", "textarea", "tsConfigContainer"))
    pages = dashboard.with_html_params(pages, "html")
    parsed = pages.withColumn("c", F.from_json("config", "sheetId string, title string, literal string"))
    return parsed.select(
        "c_custkey",
        F.col("c.sheetId").alias("sheet"),
        F.col("c.title").alias("title"),
        F.try_element_at("params", F.lit("host_url")).alias("host_url"),
        F.col("c.literal").alias("literal"),
    )
