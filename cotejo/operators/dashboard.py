"""Decoding dictionary-encoded dashboard payloads.

A payload is a JSON text: a dictionary of values per data type, in segments, and worksheets
whose columns are arrays of positions in it. One payload is one row of the input and holds
both its dictionary and its positions, so decoding works on that row alone: no shuffle and no
join, however many payloads there are. Only columns that are asked for are parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotejo.functions.arrays import spread, spread_structs
from cotejo.functions.markup import bound, unescape
from cotejo.functions.text import _col

_COLUMN = "tupleIds: array<int>, valueIndices: array<int>, aliasIndices: array<int>"
_DESCRIPTOR = (
    "fieldCaption: string, dataType: string, fn: string, isAutoSelect: boolean, "
    "paneIndices: array<int>, columnIndices: array<int>"
)
PANES = (
    f"struct<paneColumnsList: array<struct<vizPaneColumns: array<struct<{_COLUMN}>>>>, "
    f"vizDataColumns: array<struct<{_DESCRIPTOR}>>>"
)
SEGMENTS = "map<string, struct<dataColumns: array<struct<dataType: string, dataValues: array<string>>>>>"
VISUAL = f"struct<vizData: struct<paneColumnsData: {PANES}>, filtersJson: string>"
PARAMETER = "struct<fieldCaption: string, formattedValues: array<string>, parameterName: string>"
QUICK_FILTER = (
    "struct<quickFilter: struct<categoricalFilter: struct<fn: string, columnFullNames: array<string>, "
    "domainTables: array<struct<isSelected: boolean>>>>>"
)
STORY_NAV = (
    "struct<storypointNavItems: array<struct<storyPointId: bigint, storyPointCaption: string>>>"
)
_INNER_HOLDER = (
    f"visual: {VISUAL}, parameterControl: {PARAMETER}, quickFilterDisplay: {QUICK_FILTER}, "
    f"flipboardNav: {STORY_NAV}"
)
_INNER_ZONES = f"map<string, struct<worksheet: string, presModelHolder: struct<{_INNER_HOLDER}>>>"
_SHEET_PATH = "struct<storyboard: string, sheetName: string, isDashboard: boolean>"
STORY_POINTS = (
    "map<string, struct<storyPointId: bigint, dashboardPresModel: struct<"
    f"sheetPath: {_SHEET_PATH}, visualIds: array<struct<storyboard: string, dashboard: string>>, "
    f"zones: {_INNER_ZONES}>>>"
)
ZONES = (
    "map<string, struct<worksheet: string, presModelHolder: struct<"
    f"{_INNER_HOLDER}, flipboard: struct<storyPoints: {STORY_POINTS}>>>>"
)
DATA_SCHEMA = (
    "secondaryInfo struct<presModelMap: struct<"
    "vizData: struct<presModelHolder: struct<genPresModelMapPresModel: struct<presModelMap: "
    f"map<string, struct<presModelHolder: struct<genVizDataPresModel: struct<paneColumnsData: {PANES}>>>>>>>, "
    "dataDictionary: struct<presModelHolder: struct<genDataDictionaryPresModel: "
    f"struct<dataSegments: {SEGMENTS}>>>>>"
)
INFO_SCHEMA = (
    "sheetName string, worldUpdate struct<applicationPresModel: struct<workbookPresModel: struct<"
    "sheetsInfo: array<struct<sheet: string, isDashboard: boolean, isVisible: boolean, "
    "namesOfSubsheets: array<string>, windowId: string>>, "
    f"dashboardPresModel: struct<zones: {ZONES}>>>>"
)
_RESPONSE = "vqlCmdResponse struct<layoutStatus: struct<applicationPresModel: struct<{}>>>"
_RESPONSE_SEGMENTS = f"dataDictionary: struct<dataSegments: {SEGMENTS}>"
_RESPONSE_ZONES = "workbookPresModel: struct<dashboardPresModel: struct<zones: {}>>"
RESPONSE_SCHEMA = _RESPONSE.format(f"{_RESPONSE_SEGMENTS}, {_RESPONSE_ZONES.format(ZONES)}")
SEGMENTS_SCHEMA = _RESPONSE.format(_RESPONSE_SEGMENTS)
ZONES_SCHEMA = _RESPONSE.format(_RESPONSE_ZONES.format(ZONES))
# Zones and whether they have data, without the data: the one field is never there.
SEEN_SCHEMA = _RESPONSE.format(
    _RESPONSE_ZONES.format("map<string, struct<presModelHolder: struct<visual: struct<vizData: struct<`/`: string>>>>>")
)
_FLAT_COLUMN = (
    "fieldCaption: string, valueIndices: array<int>, aliasIndices: array<int>, dataType: string, fn: string"
)
DOWNLOAD_SCHEMA = (
    "vqlCmdResponse struct<cmdResultList: array<struct<commandReturn: struct<underlyingDataTable: struct<"
    f"dataDictionary: struct<dataSegments: {SEGMENTS}>, "
    f"underlyingDataTableColumns: array<struct<{_FLAT_COLUMN}>>>>>>>"
)
FILTERS_SCHEMA = (
    "array<struct<`all`: boolean, `allChecked`: boolean, `table`: struct<"
    "`schema`: array<struct<`caption`: string, `name`: array<string>, `ordinal`: int>>, "
    "`tuples`: array<struct<`t`: array<struct<`v`: string>>, `s`: boolean>>>>>"
)


# ---- raw text --------------------------------------------------------------------------


def split_body(c: Column | str) -> Column:
    """(info, data): the two JSON documents of a raw body ``length;{..}length;{..}``.

    The first one ends at the last ``}length;{`` of the text, as in a greedy match.
    """
    pattern = r"(?s)\d+;(\{.*\})\d+;(\{.*\})"
    c = _col(c)
    return F.when(
        c.rlike(pattern),
        F.struct(
            F.regexp_extract(c, pattern, 1).alias("info"), F.regexp_extract(c, pattern, 2).alias("data")
        ),
    )


def with_html_attributes(df: DataFrame, html: str, tag: str, key: str, value: str, into: str) -> DataFrame:
    """Add a map of one attribute to another over all tags of a kind; the last of equal keys
    stays.

    Attributes may be quoted either way or not at all; their character references and percent
    codes are resolved. Tags without the key attribute are skipped. The steps are columns of
    their own on purpose. An expression used inside a lambda is evaluated for every element, so
    the search through the page must not stand there.
    """

    def attribute(text: Column, name: str) -> Column:
        raw = F.regexp_extract(text, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
        plain = unescape(F.regexp_replace(raw, "^[\"']|[\"']$", ""))
        return bound(plain, lambda t: F.coalesce(F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B"))), t))

    pattern = rf"(?is)(<{tag}\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>)"
    tags = F.filter(
        F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)), lambda t: t.rlike(rf"(?is)\s{key}\s*=")
    )
    entries = F.transform(
        "__tags", lambda t, i: F.struct(attribute(t, key).alias("key"), i.alias("place"), attribute(t, value).alias("value"))
    )
    # Sorted by key and place, the last of equal keys stands before another key.
    found = df.withColumn("__tags", tags).withColumn("__entries", F.array_sort(entries))
    last = F.filter(
        "__entries", lambda e, i: ~F.coalesce(F.get("__entries", i + 1)["key"] == e["key"], F.lit(False))
    )
    pairs = F.transform(last, lambda e: F.struct(e["key"], e["value"]))
    return found.withColumn(into, F.map_from_entries(pairs)).drop("__tags", "__entries")


def html_text_of(c: Column | str, tag: str, element_id: str | None = None) -> Column:
    """Text inside the first tag of a kind, optionally the one with an id; null if there is none."""
    where = rf"[^>]*\bid\s*=\s*[\"']{element_id}[\"'][^>]*" if element_id else "[^>]*"
    text = F.regexp_extract(_col(c), rf"(?is)<{tag}\b{where}>(.*?)</{tag}>", 1)
    return bound(unescape(text), lambda t: F.when(t != "", t))


def with_html_params(df: DataFrame, html: str, into: str = "params") -> DataFrame:
    """Add the map ``name`` -> ``value`` of the ``param`` tags."""
    return with_html_attributes(df, html, "param", "name", "value", into)


# ---- parsed documents ------------------------------------------------------------------


def malformed(df: DataFrame, ids: Sequence[str], document: str) -> DataFrame:
    """Rows whose document is there but is no JSON object, with the reason; the decoders give
    no rows for them."""
    parsed = F.try_parse_json(document)
    reason = F.when(parsed.isNull(), "not JSON").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not an object")
    return df.select(*ids, F.when(F.col(document).isNotNull(), reason).alias("reason")).filter("reason is not null")


def parse_data(c: Column | str) -> Column:
    return F.from_json(_col(c), DATA_SCHEMA)


def parse_info(c: Column | str) -> Column:
    return F.from_json(_col(c), INFO_SCHEMA)


def parse_response(c: Column | str, schema: str = RESPONSE_SCHEMA) -> Column:
    """A command response, or the parts of it that ``schema`` has."""
    return F.from_json(_col(c), schema)


def parse_download(c: Column | str) -> Column:
    """Table (dictionary and columns) of the first result of a download command."""
    results = F.from_json(_col(c), DOWNLOAD_SCHEMA)["vqlCmdResponse"]["cmdResultList"]
    return F.get(results, F.lit(0))["commandReturn"]["underlyingDataTable"]


def data_models(data: Column) -> Column:
    """Map worksheet name -> model of a first (bootstrap) document; its keys are the
    worksheets."""
    return data["secondaryInfo"]["presModelMap"]["vizData"]["presModelHolder"]["genPresModelMapPresModel"]["presModelMap"]


def worksheet_panes(data: Column, worksheet: str) -> Column:
    """Pane columns of one worksheet, null when it is missing or has no data."""
    model = F.try_element_at(data_models(data), F.lit(worksheet))
    return model["presModelHolder"]["genVizDataPresModel"]["paneColumnsData"]


def data_segments(data: Column) -> Column:
    return data["secondaryInfo"]["presModelMap"]["dataDictionary"]["presModelHolder"]["genDataDictionaryPresModel"]["dataSegments"]


def info_zones(info: Column) -> Column:
    return info["worldUpdate"]["applicationPresModel"]["workbookPresModel"]["dashboardPresModel"]["zones"]


def response_zones(response: Column) -> Column:
    return response["vqlCmdResponse"]["layoutStatus"]["applicationPresModel"]["workbookPresModel"]["dashboardPresModel"]["zones"]


def response_segments(response: Column) -> Column:
    return response["vqlCmdResponse"]["layoutStatus"]["applicationPresModel"]["dataDictionary"]["dataSegments"]


def _entries(zones: Column) -> Column:
    return F.filter(
        F.coalesce(F.map_entries(zones), F.array()), lambda e: e["value"].isNotNull()
    )


def _is_visual(zone: Column) -> Column:
    return zone["worksheet"].isNotNull() & zone["presModelHolder"]["visual"].isNotNull()


def _has_data(zone: Column) -> Column:
    return _is_visual(zone) & zone["presModelHolder"]["visual"]["vizData"].isNotNull()


def story_zones(zones: Column) -> Column:
    """Zones of the first story point of the first story zone, null when there is no story."""
    stories = F.filter(
        _entries(zones), lambda e: e["value"]["presModelHolder"]["flipboard"]["storyPoints"].isNotNull()
    )
    first = F.get(stories, F.lit(0))["value"]["presModelHolder"]["flipboard"]["storyPoints"]
    return F.get(F.map_values(first), F.lit(0))["dashboardPresModel"]["zones"]


def zone_worksheets(zones: Column, with_data: bool = False) -> Column:
    """Worksheet names of the zones that show a visual (and, if asked, carry its data)."""
    shown = _has_data if with_data else _is_visual
    return F.transform(F.filter(_entries(zones), lambda e: shown(e["value"])), lambda e: e["value"]["worksheet"])


def zone_panes(zones: Column) -> Column:
    """Array of (worksheet, panes) of the zones that carry data, in document order."""
    return F.transform(
        F.filter(_entries(zones), lambda e: _has_data(e["value"])),
        lambda e: F.struct(
            e["value"]["worksheet"].alias("worksheet"),
            e["value"]["presModelHolder"]["visual"]["vizData"]["paneColumnsData"].alias("panes"),
        ),
    )


# ---- columns and dictionary ------------------------------------------------------------


def descriptors(
    panes: Column,
    every_pane: bool = True,
    auto_select_only: bool = False,
    without_caption: bool = False,
) -> Column:
    """Array of column descriptors with their position arrays.

    A column needs a caption unless ``without_caption``. ``every_pane`` gives one entry per
    pane of the column, otherwise only the first pane is taken (command responses).
    """
    named = F.filter(
        panes["vizDataColumns"],
        lambda c: (F.lit(without_caption) | (F.coalesce(c["fieldCaption"], F.lit("")) != ""))
        & (F.lit(not auto_select_only) | F.coalesce(c["isAutoSelect"], F.lit(False))),
    )

    def entry(c: Column, pane: Column, column: Column) -> Column:
        cell = F.get(F.get(panes["paneColumnsList"], pane)["vizPaneColumns"], column)
        return F.struct(
            F.coalesce(c["fieldCaption"], F.lit("")).alias("fieldCaption"),
            F.coalesce(cell["tupleIds"], F.array().cast("array<int>")).alias("tupleIds"),
            F.coalesce(cell["valueIndices"], F.array().cast("array<int>")).alias("valueIndices"),
            F.coalesce(cell["aliasIndices"], F.array().cast("array<int>")).alias("aliasIndices"),
            F.coalesce(c["dataType"], F.lit("")).alias("dataType"),
            pane.alias("paneIndices"),
            column.alias("columnIndices"),
            F.coalesce(c["fn"], F.lit("")).alias("fn"),
        )

    def entries(c: Column) -> Column:
        places = F.arrays_zip(c["paneIndices"].alias("pane"), c["columnIndices"].alias("column"))
        if not every_pane:
            places = F.slice(places, 1, 1)
        return F.transform(places, lambda p: entry(c, p["pane"], p["column"]))

    return F.flatten(F.transform(named, entries))


def value_dictionary(segments: Column, persisted: Column | None = None) -> Column:
    """Map data type -> array of values, over all segments in document order.

    Segments persisted from earlier responses come first; a new segment with a persisted id
    is skipped.
    """
    if persisted is not None:
        old = F.coalesce(F.map_entries(persisted), F.array())
        known = F.coalesce(F.map_keys(persisted), F.array())
        fresh = F.filter(F.map_entries(segments), lambda e: ~F.array_contains(known, e["key"]))
        ordered = F.concat(old, F.coalesce(fresh, F.array()))
    else:
        ordered = F.map_entries(segments)
    usable = F.filter(ordered, lambda e: e["value"].isNotNull())
    return dictionary_of(F.flatten(F.transform(usable, lambda e: e["value"]["dataColumns"])))


def dictionary_of(columns: Column) -> Column:
    """Map data type -> array of values out of the (dataType, dataValues) of ordered segments."""
    types = F.array_distinct(F.transform(columns, lambda c: c["dataType"]))
    return F.map_from_entries(
        F.transform(
            types,
            lambda t: F.struct(
                t.alias("key"),
                F.flatten(
                    F.transform(F.filter(columns, lambda c: c["dataType"] == t), lambda c: c["dataValues"])
                ).alias("value"),
            ),
        )
    )


def at_position(position: Column, values: Column, text: Column) -> Column:
    """Value at a position; a negative position reads the text dictionary from its front."""
    return F.when(position >= 0, F.get(values, position)).otherwise(F.get(text, F.abs(position) - 1))


def name_columns(df: DataFrame, ids: Sequence[str], columns: Column, kept: Sequence[str], into: str) -> DataFrame:
    """Add the array (name, dataType, positions) of the value and the alias column of each
    descriptor that has positions.

    The first column of a caption is called ``caption-value`` or ``caption-alias``, later ones
    ``caption-fn-value``. Only names are compared here, no values are touched.
    """
    parts = F.filter(
        F.flatten(
            F.transform(
                columns,
                lambda d: F.array(
                    *[
                        F.struct(
                            F.concat_ws("-", d["fieldCaption"], F.lit(kind)).alias("short"),
                            F.concat_ws("-", d["fieldCaption"], d["fn"], F.lit(kind)).alias("long"),
                            d["dataType"].alias("dataType"),
                            d[source].alias("positions"),
                        )
                        for kind, source in (("value", "valueIndices"), ("alias", "aliasIndices"))
                    ]
                ),
            )
        ),
        lambda p: F.size(p["positions"]) > 0,
    )
    # The parts are a column before they are compared with each other.
    listed = df.select(*ids, *kept, parts.alias("__parts"))
    named = F.transform(
        "__parts",
        lambda p, i: F.struct(
            F.when(F.array_position(F.col("__parts.short"), p["short"]) == i + 1, p["short"])
            .otherwise(p["long"])
            .alias("name"),
            p["dataType"].alias("dataType"),
            p["positions"].alias("positions"),
        ),
    )
    return listed.select(*ids, *kept, named.alias(into))


def decode_columns(
    df: DataFrame,
    ids: Sequence[str],
    named: str,
    dictionary: str,
    names: Sequence[str],
    row_number: str = "row_no",
    fill: str = "0",
) -> DataFrame:
    """Flat table out of named position arrays and a dictionary map, columns side by side.

    Positions past the end of the dictionary are dropped, a data type without a dictionary is
    looked up in the text dictionary, missing cells become ``fill``. ``names`` lists the
    output columns, and only these are decoded; one that a payload lacks is ``fill``. Of
    several columns with one name the last stays.

    Each step is a set of columns: the lambdas of the last one refer to finished arrays.
    """
    none = F.array().cast("array<string>")
    width = range(len(names))

    def last_called(name: str) -> Column:
        return F.try_element_at(F.filter(F.col(named), lambda c: c["name"] == name), F.lit(-1))

    text = F.coalesce(F.try_element_at(F.col(dictionary), F.lit("cstring")), none)
    picked = df.select(
        *ids,
        F.col(dictionary),
        text.alias("__text"),
        *[last_called(name).alias(f"__c{i}") for i, name in enumerate(names)],
    )
    located = picked.select(
        *ids,
        "__text",
        *[F.coalesce(F.col(f"__c{i}")["positions"], F.array().cast("array<int>")).alias(f"__p{i}") for i in width],
        *[
            F.coalesce(
                F.try_element_at(F.col(dictionary), F.col(f"__c{i}")["dataType"]), F.col("__text")
            ).alias(f"__v{i}")
            for i in width
        ],
    )

    def decoded(i: int) -> Column:
        values, positions = F.col(f"__v{i}"), F.col(f"__p{i}")
        inside = F.filter(positions, lambda at: at < F.size(values))
        return F.transform(inside, lambda at: at_position(at, values, F.col("__text")))

    resolved = located.select(*ids, *[decoded(i).alias(f"__a{i}") for i in width])
    zipped = F.arrays_zip(*[F.col(f"__a{i}") for i in width])
    rows = spread(resolved, ids, zipped, "__row", position=row_number)
    return rows.select(
        *ids,
        row_number,
        *[F.coalesce(F.col("__row")[f"__a{i}"], F.lit(fill)).alias(n) for i, n in enumerate(names)],
    )


def decode_worksheet(
    df: DataFrame,
    ids: Sequence[str],
    payload: str,
    worksheet: str,
    names: Sequence[str],
    persisted: str | None = None,
    row_number: str = "row_no",
    info: str | None = None,
) -> DataFrame:
    """Flat table of one worksheet out of bootstrap documents; no rows where it is missing.

    ``persisted`` is a column with the segment map of the session, where there is one.
    ``info`` is a column with the first document of the body: a workbook that is a story has
    its columns there, in the zones of its first point, of which the first panes count.
    """
    kept = [persisted] if persisted else []
    documents = [parse_data(payload).alias("__d")]
    if info:
        documents.append(parse_info(info).alias("__i"))
    data = df.select(*ids, *kept, *documents)
    story = []
    if info:
        zones = story_zones(info_zones(F.col("__i")))
        found = F.filter(zone_panes(zones), lambda z: z["worksheet"] == worksheet)
        is_story = data_models(F.col("__d")).isNull()
        story = [F.when(is_story, F.get(found, F.lit(0))["panes"]).alias("__story")]
    opened = data.select(
        *ids,
        *kept,
        worksheet_panes(F.col("__d"), worksheet).alias("__panes"),
        data_segments(F.col("__d")).alias("__segments"),
        *story,
    )
    return _decode_opened(opened, ids, True, names, persisted, row_number, "__story" if info else None)


def decode_response(
    df: DataFrame,
    ids: Sequence[str],
    payload: str,
    worksheet: str,
    names: Sequence[str],
    persisted: str | None = None,
    row_number: str = "row_no",
) -> DataFrame:
    """The same out of command responses; zones of a story are used when there are no others."""
    kept = [persisted] if persisted else []
    data = df.select(*ids, *kept, parse_response(payload).alias("__d"))
    zones = response_zones(F.col("__d"))
    found = F.filter(
        F.concat(zone_panes(zones), zone_panes(story_zones(zones))), lambda z: z["worksheet"] == worksheet
    )
    opened = data.select(
        *ids,
        *kept,
        F.get(found, F.lit(0))["panes"].alias("__panes"),
        response_segments(F.col("__d")).alias("__segments"),
    )
    return _decode_opened(opened, ids, False, names, persisted, row_number)


def _decode_opened(opened, ids, every_pane, names, persisted, row_number, story=None):
    dictionary = value_dictionary(F.col("__segments"), F.col(persisted) if persisted else None)
    parsed = opened.select(*ids, "__panes", dictionary.alias("__dictionary"), *([story] if story else []))
    columns = descriptors(F.col("__panes"), every_pane)
    if story:
        columns = F.coalesce(columns, descriptors(F.col(story), every_pane=False))
    parsed = name_columns(parsed, ids, columns, ["__dictionary"], "__named")
    return decode_columns(parsed, ids, "__named", "__dictionary", names, row_number)


def decode_flat(
    df: DataFrame, ids: Sequence[str], columns: str, dictionary: str, names: Sequence[str], row_number: str = "row_no"
) -> DataFrame:
    """Downloaded data: position arrays given flat per column, next to a dictionary map."""
    captioned = F.filter(F.col(columns), lambda c: F.coalesce(c["fieldCaption"], F.lit("")) != "")
    parsed = name_columns(df, ids, captioned, [dictionary], "__named")
    return decode_columns(parsed, ids, "__named", dictionary, names, row_number)


# ---- catalogues ------------------------------------------------------------------------


def list_zones(df: DataFrame, ids: Sequence[str], zones: str, with_data: bool = False) -> DataFrame:
    """One row per zone that shows a worksheet, with its zone id."""
    shown = _has_data if with_data else _is_visual
    kept = F.filter(_entries(F.col(zones)), lambda e: shown(e["value"]))
    return spread(df, ids, kept, "__z").select(
        *ids, F.col("__z.key").alias("zone"), F.col("__z.value.worksheet").alias("worksheet")
    )


def list_sheets(df: DataFrame, ids: Sequence[str], info: str) -> DataFrame:
    """Sheets of a workbook."""
    sheets = F.col(info)["worldUpdate"]["applicationPresModel"]["workbookPresModel"]["sheetsInfo"]
    return spread_structs(df, ids, sheets)


def list_story_points(df: DataFrame, ids: Sequence[str], info: str) -> DataFrame:
    """Story points in navigation order; ``board`` counts the navigation zones."""
    navigation = F.transform(
        F.filter(
            _entries(info_zones(F.col(info))),
            lambda e: e["value"]["presModelHolder"]["flipboardNav"]["storypointNavItems"].isNotNull(),
        ),
        lambda e: e["value"]["presModelHolder"]["flipboardNav"]["storypointNavItems"],
    )
    boards = spread(df, [*ids, F.col(info)["sheetName"].alias("storyBoard")], navigation, "__items", position="board")
    return spread_structs(boards, [*ids, "storyBoard", "board"], "__items")


def parameter_catalogue(df: DataFrame, ids: Sequence[str], zones: str) -> DataFrame:
    """Parameters with their selectable values; those of a story when the workbook is one."""
    def controls_of(part: Column) -> Column:
        return F.transform(
            F.filter(_entries(part), lambda e: e["value"]["presModelHolder"]["parameterControl"].isNotNull()),
            lambda e: e["value"]["presModelHolder"]["parameterControl"],
        )

    whole, story = F.col(zones), story_zones(F.col(zones))
    controls = F.when(F.size(_entries(story)) > 0, controls_of(story)).otherwise(controls_of(whole))
    return spread_structs(df, ids, controls).select(
        *ids, F.col("fieldCaption").alias("column"), F.col("formattedValues").alias("values"), "parameterName"
    )


def _zone_filters(zones: Column) -> Column:
    """Array of filters (worksheet, column, ordinal, values, selection, name, quick filters)."""
    visuals = F.filter(
        _entries(zones),
        lambda e: e["value"]["worksheet"].isNotNull()
        & e["value"]["presModelHolder"]["visual"]["filtersJson"].isNotNull(),
    )
    quick = F.filter(
        _entries(zones),
        lambda e: e["value"]["worksheet"].isNotNull()
        & e["value"]["presModelHolder"]["quickFilterDisplay"]["quickFilter"]["categoricalFilter"].isNotNull(),
    )

    def of_visual(e: Column) -> Column:
        zone = e["value"]
        parsed = F.from_json(zone["presModelHolder"]["visual"]["filtersJson"], FILTERS_SCHEMA)
        complete = F.filter(
            parsed, lambda f: f["table"]["schema"].isNotNull() & f["table"]["tuples"].isNotNull()
        )

        def of_filter(f: Column) -> Column:
            filled = F.filter(f["table"]["tuples"], lambda t: F.coalesce(F.size(t["t"]), F.lit(0)) > 0)
            values = F.transform(filled, lambda t: t["t"][0]["v"])
            chosen = F.transform(
                F.filter(filled, lambda t: F.coalesce(t["s"], F.lit(False))), lambda t: t["t"][0]["v"]
            )
            everything = F.coalesce(f["all"], F.lit(False)) | F.coalesce(f["allChecked"], F.lit(False))

            def of_column(c: Column) -> Column:
                name = F.concat(F.lit("["), c["name"][0], F.lit("].["), c["name"][1], F.lit("]"))
                return F.struct(
                    zone["worksheet"].alias("worksheet"),
                    c["caption"].alias("column"),
                    c["ordinal"].alias("ordinal"),
                    values.alias("values"),
                    name.alias("globalFieldName"),
                    F.when(everything, F.concat(values, F.array(F.lit("all"))))
                    .otherwise(chosen)
                    .alias("selection"),
                    F.transform(
                        F.filter(
                            quick,
                            lambda q: (q["value"]["worksheet"] == zone["worksheet"])
                            & (
                                q["value"]["presModelHolder"]["quickFilterDisplay"]["quickFilter"]["categoricalFilter"]["fn"]
                                == name
                            ),
                        ),
                        lambda q: q["value"]["presModelHolder"]["quickFilterDisplay"]["quickFilter"]["categoricalFilter"],
                    ).alias("selectionAlt"),
                )

            return F.transform(f["table"]["schema"], of_column)

        return F.flatten(F.transform(complete, of_filter))

    return F.flatten(F.transform(visuals, of_visual))


def filter_catalogue(df: DataFrame, ids: Sequence[str], zones: str) -> DataFrame:
    """Filters per worksheet: column, ordinal, selectable values, current selection (all values
    and the marker ``all`` when everything is chosen), global name, matching quick filters."""
    return spread_structs(df, ids, _zone_filters(F.col(zones)))


def story_filter_catalogue(df: DataFrame, ids: Sequence[str], zones: str, root_dashboard: str) -> DataFrame:
    """The same over all story points, with the story each filter belongs to."""
    stories = F.filter(
        _entries(F.col(zones)), lambda e: e["value"]["presModelHolder"]["flipboard"]["storyPoints"].isNotNull()
    )
    first = F.get(stories, F.lit(0))["value"]["presModelHolder"]["flipboard"]["storyPoints"]
    points = spread(df, ids, first, "__key", "__point")
    board = F.col("__point.dashboardPresModel")
    described = points.select(
        *ids,
        F.coalesce(board["sheetPath"]["storyboard"], F.get(board["visualIds"], F.lit(0))["storyboard"]).alias("storyboard"),
        F.col("__point.storyPointId").alias("storyboardId"),
        F.when(board["sheetPath"]["isDashboard"], board["sheetPath"]["sheetName"])
        .when(board["sheetPath"].isNotNull(), F.lit(root_dashboard))
        .otherwise(F.get(board["visualIds"], F.lit(0))["dashboard"])
        .alias("dashboard"),
        _zone_filters(board["zones"]).alias("__filters"),
    )
    return spread_structs(described, [*ids, "storyboard", "storyboardId", "dashboard"], "__filters")


# ---- session state ---------------------------------------------------------------------


def merge_state(
    old: DataFrame, new: DataFrame, keys: Sequence[str], policy: str, value: str = "value", has_data: str = "has_data"
) -> DataFrame:
    """Merge a keyed state with the state of a new response.

    ``segments``    a new value that is not null replaces the old one;
    ``parameters``  the old value stays, new keys are added;
    ``filters``     the new value replaces the old one;
    ``zones``       the new state replaces everything, but a new zone without data keeps its
                    old content; new null zones are dropped.

    Keys are unique per state. Both states are stacked and grouped once; the value is kept in
    a struct, so that "present but null" stays apart from "absent".
    """
    keep = "value" if policy != "zones" else None
    extra = [has_data] if keep is None else []

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*keys, F.struct(F.col(value).alias("v"), *[F.col(c).alias("d") for c in extra]).alias(mark))

    stacked = side(old, "__old").unionByName(side(new, "__new"), allowMissingColumns=True)
    grouped = stacked.groupBy(*keys).agg(F.max("__old").alias("__old"), F.max("__new").alias("__new"))
    o, n = F.col("__old"), F.col("__new")
    if policy == "segments":
        merged, kept = F.coalesce(n["v"], o["v"]), o.isNotNull() | n["v"].isNotNull()
    elif policy == "parameters":
        merged, kept = F.when(o.isNotNull(), o["v"]).otherwise(n["v"]), F.lit(True)
    elif policy == "filters":
        merged, kept = F.when(n.isNotNull(), n["v"]).otherwise(o["v"]), F.lit(True)
    elif policy == "zones":
        stale = ~F.coalesce(n["d"], F.lit(False)) & o.isNotNull()
        merged, kept = F.when(stale, o["v"]).otherwise(n["v"]), n["v"].isNotNull()
    else:
        raise ValueError(f"unknown policy {policy}")
    return grouped.filter(kept).select(*keys, merged.alias(value))


def value_position(values: Column | str, wanted: Column | str, tuple_ids: Column | str | None = None) -> Column:
    """Selection number of a value: its tuple id when an id list is long enough, otherwise its
    1-based position; null when the value is not there.

    ``tuple_ids`` is an array of id lists, of which the first that is long enough counts.
    """
    values, wanted = _col(values), _col(wanted)
    position = F.array_position(values, wanted).cast("int")
    if tuple_ids is None:
        return F.nullif(position, F.lit(0))
    ids = F.get(F.filter(_col(tuple_ids), lambda t: F.size(t) >= F.size(values)), F.lit(0))
    return F.when(
        position > 0, F.when(ids.isNotNull(), F.get(ids, position - 1)).otherwise(position)
    )


def worksheet_frames(frames: dict[str, DataFrame], name: str) -> DataFrame | None:
    """Frame of a worksheet; for an unknown name an empty frame with the columns of the first."""
    if name in frames:
        return frames[name]
    return next((f.limit(0) for f in frames.values()), None)
