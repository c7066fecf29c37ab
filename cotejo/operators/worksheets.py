"""All worksheets and columns of dashboard payloads, without naming any.

``open_*`` parse a document once and give one row per worksheet: its column descriptors beside
the dictionary that their positions refer to. ``decode_all`` and ``selectable_items`` read such
rows. ``open_sessions`` builds them from the responses of whole sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotejo.functions.arrays import spread
from cotejo.operators import dashboard

OPENED = ["sheet_no", "worksheet", "columns", "dictionary"]
_SHEET = f"array<struct<worksheet: string, panes: {dashboard.PANES}>>"


def _first_of_name(sheets: Column) -> Column:
    """Sheets whose name no earlier one has."""
    names = F.transform(sheets, lambda s: s["worksheet"])
    return F.filter(sheets, lambda s, i: F.array_position(names, s["worksheet"]) == i + 1)


def _one_row_each(df: DataFrame, ids: Sequence[str], every_pane: Column) -> DataFrame:
    """From the arrays ``__sheets`` and the map ``dictionary`` to one row per sheet."""
    sheets = spread(df, [*ids, "dictionary", every_pane.alias("__every")], "__sheets", "__s", position="sheet_no")
    panes = F.col("__s.panes")
    columns = F.when(F.col("__every"), dashboard.descriptors(panes)).otherwise(dashboard.descriptors(panes, every_pane=False))
    return sheets.select(*ids, "sheet_no", F.col("__s.worksheet").alias("worksheet"), columns.alias("columns"), "dictionary")


def open_payloads(
    df: DataFrame, ids: Sequence[str], payload: str, persisted: str | None = None, info: str | None = None
) -> DataFrame:
    """(ids, sheet_no, worksheet, columns, dictionary) of every worksheet of bootstrap documents.

    ``persisted`` is a column with the segment map of the session. ``info`` is a column with the
    first document of the body: a workbook that is a story has its sheets there, in the zones of
    its first point, with the first pane of each column. Null or malformed documents give no rows.
    """
    kept = [persisted] if persisted else []
    documents = [dashboard.parse_data(payload).alias("__d")]
    if info:
        documents.append(dashboard.parse_info(info).alias("__i"))
    parsed = df.select(*ids, *kept, *documents)
    models = dashboard.data_models(F.col("__d"))
    sheets = F.transform(
        F.map_entries(models),
        lambda e: F.struct(
            e["key"].alias("worksheet"),
            e["value"]["presModelHolder"]["genVizDataPresModel"]["paneColumnsData"].alias("panes"),
        ),
    )
    if info:
        sheets = F.coalesce(sheets, dashboard.zone_panes(dashboard.story_zones(dashboard.info_zones(F.col("__i")))))
    listed = parsed.select(
        *ids, *kept, sheets.cast(_SHEET).alias("__sheets"), models.isNotNull().alias("__own"), dashboard.data_segments(F.col("__d")).alias("__segments")
    )
    dictionary = dashboard.value_dictionary(F.col("__segments"), F.col(persisted) if persisted else None)
    opened = listed.select(*ids, _first_of_name(F.col("__sheets")).alias("__sheets"), "__own", dictionary.alias("dictionary"))
    return _one_row_each(opened, ids, F.col("__own"))


def open_responses(df: DataFrame, ids: Sequence[str], payload: str, persisted: str | None = None) -> DataFrame:
    """The same of command responses: zones with data, or else those of the first story point."""
    kept = [persisted] if persisted else []
    parsed = df.select(*ids, *kept, dashboard.parse_response(payload).alias("__d"))
    listed = parsed.select(
        *ids,
        *kept,
        dashboard.response_zones(F.col("__d")).alias("__zones"),
        dashboard.response_segments(F.col("__d")).alias("__segments"),
    )
    dictionary = dashboard.value_dictionary(F.col("__segments"), F.col(persisted) if persisted else None)
    opened = listed.select(
        *ids,
        dashboard.zone_panes(F.col("__zones")).alias("__shown"),
        dashboard.zone_panes(dashboard.story_zones(F.col("__zones"))).alias("__story"),
        dictionary.alias("dictionary"),
    )
    sheets = F.when(F.size("__shown") > 0, F.col("__shown")).otherwise(F.col("__story"))
    return _one_row_each(opened.select(*ids, sheets.alias("__sheets"), "dictionary"), ids, F.lit(False))


def open_downloads(df: DataFrame, ids: Sequence[str], payload: str, persisted: str | None = None) -> DataFrame:
    """The same of answers to a download command, which hold one table; its worksheet is null.

    Segments of the session (``persisted``) come before those of the answer.
    """
    kept = [persisted] if persisted else []
    parsed = df.select(*ids, *kept, dashboard.parse_download(payload).alias("__t"))
    listed = parsed.filter("__t is not null").select(
        *ids, *kept, F.col("__t.underlyingDataTableColumns").alias("__columns"), F.col("__t.dataDictionary.dataSegments").alias("__segments")
    )
    none = F.array().cast("array<int>")
    columns = F.transform(
        F.filter("__columns", lambda c: F.coalesce(c["fieldCaption"], F.lit("")) != ""),
        lambda c: F.struct(
            c["fieldCaption"].alias("fieldCaption"),
            F.coalesce(c["valueIndices"], none).alias("valueIndices"),
            F.coalesce(c["aliasIndices"], none).alias("aliasIndices"),
            F.coalesce(c["dataType"], F.lit("")).alias("dataType"),
            F.coalesce(c["fn"], F.lit("")).alias("fn"),
        ),
    )
    dictionary = dashboard.value_dictionary(F.col("__segments"), F.col(persisted) if persisted else None)
    return listed.select(
        *ids,
        F.lit(0).alias("sheet_no"),
        F.lit(None).cast("string").alias("worksheet"),
        columns.alias("columns"),
        dictionary.alias("dictionary"),
    )


def decode_download(
    df: DataFrame, ids: Sequence[str], payload: str, names: Sequence[str], persisted: str | None = None, row_number: str = "row_no"
) -> DataFrame:
    """Table of an answer to a download command, the columns ``names`` side by side."""
    opened = open_downloads(df, ids, payload, persisted)
    named = dashboard.name_columns(opened, ids, F.col("columns"), ["dictionary"], "__named")
    return dashboard.decode_columns(named, ids, "__named", "dictionary", names, row_number)


def _values(kind: Column, dictionary: str = "dictionary") -> Column:
    """Values of a data type; one that the dictionary lacks is looked up among the texts."""
    none = F.array().cast("array<string>")
    return F.coalesce(
        F.try_element_at(F.col(dictionary), kind), F.try_element_at(F.col(dictionary), F.lit("cstring")), none
    )


def _with_cells(df: DataFrame, kept: Sequence[str], positions: str, kind: str) -> DataFrame:
    """Add ``__cells``: the values at the positions, without those past the end."""
    looked = df.select(
        *kept,
        F.col(positions).alias("__p"),
        _values(F.col(kind)).alias("__values"),
        _values(F.lit("cstring")).alias("__text"),
    )
    inside = F.filter("__p", lambda at: at < F.size("__values"))
    return looked.select(
        *kept, F.transform(inside, lambda at: dashboard.at_position(at, F.col("__values"), F.col("__text"))).alias("__cells")
    )


def decode_all(opened: DataFrame, ids: Sequence[str], fill: str = "0") -> DataFrame:
    """Every cell of opened worksheets: ids, sheet_no, worksheet, row_no, column_no, column, value.

    Columns are named and ordered as the wide form has them: ``caption-value`` or
    ``caption-alias``, later ones of a caption ``caption-fn-value``; of several with one name the
    last counts, at the first one's place. Each column has as many rows as the longest of its
    worksheet, missing cells are ``fill``. Worksheets without columns give no rows. No shuffle: a
    worksheet's cells are made where its payload is.
    """
    keys = [*ids, "sheet_no", "worksheet"]
    named = dashboard.name_columns(opened, keys, F.col("columns"), ["dictionary"], "__named")
    first = F.filter("__named", lambda c, i: F.array_position(F.col("__named.name"), c["name"]) == i + 1)
    last = F.transform(
        first,
        lambda c: F.try_element_at(F.filter("__named", lambda d: d["name"] == c["name"]), F.lit(-1)),
    )
    listed = named.select(*keys, "dictionary", last.alias("__last"))
    sized = F.transform(
        "__last",
        lambda c: F.struct(
            c["name"].alias("name"), c["dataType"].alias("dataType"), c["positions"].alias("positions"), F.size(_values(c["dataType"])).alias("size")
        ),
    )
    listed = listed.select(*keys, "dictionary", sized.alias("__sized"))
    longest = F.array_max(F.transform("__sized", lambda c: F.size(F.filter(c["positions"], lambda at: at < c["size"]))))
    each = spread(listed, [*keys, "dictionary", longest.alias("__n")], "__sized", "__c", position="column_no")
    each = each.select(
        *keys, "dictionary", "__n", "column_no", F.col("__c.name").alias("column"), F.col("__c.positions").alias("__positions"), F.col("__c.dataType").alias("__kind")
    )
    cells = _with_cells(each, [*keys, "__n", "column_no", "column"], "__positions", "__kind")
    numbers = F.when(F.col("__n") > 0, F.sequence(F.lit(0), F.col("__n") - 1))
    rows = spread(cells, [*keys, "column_no", "column", "__cells"], numbers, "row_no")
    value = F.coalesce(F.get("__cells", F.col("row_no")), F.lit(fill))
    return rows.select(*keys, "row_no", "column_no", "column", value.alias("value"))


def selectable_items(opened: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Values to choose from per worksheet column: ids, sheet_no, worksheet, column_no, column,
    values; the column's values, or its aliases where it has no values."""
    keys = [*ids, "sheet_no", "worksheet"]
    each = spread(opened, [*keys, "dictionary"], "columns", "__c", position="column_no")
    positions = F.when(F.size("__c.valueIndices") > 0, F.col("__c.valueIndices")).otherwise(F.col("__c.aliasIndices"))
    each = each.select(
        *keys, "dictionary", "column_no", F.col("__c.fieldCaption").alias("column"), positions.alias("__positions"), F.col("__c.dataType").alias("__kind")
    )
    kept = [*keys, "column_no", "column"]
    return _with_cells(each, kept, "__positions", "__kind").withColumnRenamed("__cells", "values")


# ---- sessions ----------------------------------------------------------------------------

# Step of what a session knows before its first response.
BEFORE = -(1 << 63)


def _segments_of(df: DataFrame, kept: Sequence[str], segments: Column) -> DataFrame:
    entries = F.filter(F.coalesce(F.map_entries(segments), F.array()), lambda e: e["value"].isNotNull())
    return spread(df, kept, entries, "__e", position="place").select(
        *kept, "place", F.col("__e.key").alias("segment"), F.col("__e.value").alias("value")
    )


def _zone_rows(df: DataFrame, kept: Sequence[str], zones: Column) -> DataFrame:
    """One row per zone that is not null: its place and its entry ``__e``."""
    entries = F.filter(F.coalesce(F.map_entries(zones), F.array()), lambda e: e["value"].isNotNull())
    return spread(df, kept, entries, "__e", position="place")


def _seen_of(df: DataFrame, kept: Sequence[str], zones: Column) -> DataFrame:
    """One row per zone that is not null: its id and place, and whether it has data."""
    has_data = F.col("__e.value.presModelHolder.visual.vizData").isNotNull()
    return _zone_rows(df, kept, zones).select(*kept, F.col("__e.key").alias("zone"), "place", has_data.alias("has_data"))


def _zones_of(df: DataFrame, kept: Sequence[str], zones: Column) -> DataFrame:
    """One row per zone that is not null: its id, worksheet, panes (null without data), and the
    sheets of its own story (null where it is none)."""
    listed = _zone_rows(df, kept, zones)
    holder = F.col("__e.value.presModelHolder")
    story = dashboard.zone_panes(dashboard.story_zones(F.map_from_entries(F.array("__e"))))
    return listed.select(
        *kept,
        F.col("__e.key").alias("zone"),
        F.col("__e.value.worksheet").alias("worksheet"),
        holder["visual"]["vizData"].isNotNull().alias("has_data"),
        holder["visual"]["vizData"]["paneColumnsData"].alias("panes"),
        F.when(holder["flipboard"]["storyPoints"].isNotNull(), story).alias("story"),
    )


def session_dictionary(
    responses: DataFrame, keys: Sequence[str], step: str, payload: str, bootstrap: DataFrame | None = None, data: str = "data"
) -> DataFrame:
    """(keys, dictionary) after all responses of a session.

    A segment stays at the place where it first came and has its newest content that is not
    null; positions refer to the segments in this order. The order is kept as (first step, place
    in that document) and the content as the one of the greatest step, both in one aggregation
    by (keys, segment) that tasks begin before the shuffle, so that a session with many
    responses sends one row per segment and task. Only these rows meet per session.
    """
    document = dashboard.parse_response(payload, dashboard.SEGMENTS_SCHEMA)
    parsed = responses.select(*keys, F.col(step).alias("__step"), document.alias("__d"))
    rows = _segments_of(parsed, [*keys, "__step"], dashboard.response_segments(F.col("__d")))
    if bootstrap is not None:
        first = bootstrap.select(*keys, F.lit(BEFORE).cast("long").alias("__step"), dashboard.parse_data(data).alias("__d"))
        rows = rows.unionByName(_segments_of(first, [*keys, "__step"], dashboard.data_segments(F.col("__d"))))
    newest = rows.groupBy(*keys, "segment").agg(
        F.min(F.struct("__step", "place")).alias("order"), F.max_by("value", "__step").alias("value")
    )
    state = newest.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("order", "segment", "value"))).alias("__s"))
    columns = F.flatten(F.transform("__s", lambda s: s["value"]["dataColumns"]))
    state = state.select(*keys, columns.alias("__columns"))
    return state.select(*keys, dashboard.dictionary_of(F.col("__columns")).alias("dictionary"))


def session_zones(
    responses: DataFrame, keys: Sequence[str], step: str, payload: str, bootstrap: DataFrame | None = None, info: str = "info"
) -> DataFrame:
    """(keys, place, zone, worksheet, has_data, panes, story) after all responses of a session.

    The zones are those of the newest response. One without data has the content of the response
    before, as long as the zone was in each response since: its newest content with data since
    it last appeared, or else the one it appeared with. Which step's content a zone has is found
    on rows without content, for which no content is parsed; contents are then joined by (keys, zone, step).
    """
    steps = responses.select(*keys, F.col(step).alias("__step"))
    by_session = Window.partitionBy(*keys).orderBy("__step")
    steps = steps.select(*keys, "__step", F.coalesce(F.lag("__step").over(by_session), F.lit(BEFORE)).alias("__before"))
    kept = [*keys, "__step"]

    def zones_in(schema, listed):
        parsed = responses.select(*keys, F.col(step).alias("__step"), dashboard.parse_response(payload, schema).alias("__d"))
        return listed(parsed, kept, dashboard.response_zones(F.col("__d")))

    zones, seen = zones_in(dashboard.ZONES_SCHEMA, _zones_of), zones_in(dashboard.SEEN_SCHEMA, _seen_of)
    if bootstrap is not None:
        first = bootstrap.select(*keys, F.lit(BEFORE).cast("long").alias("__step"), dashboard.parse_info(info).alias("__i"))
        zones = zones.unionByName(_zones_of(first, kept, dashboard.info_zones(F.col("__i"))))
        seen = seen.unionByName(_seen_of(first, kept, dashboard.info_zones(F.col("__i"))))
    seen = seen.join(steps, kept, "left")
    by_zone = Window.partitionBy(*keys, "zone").orderBy("__step")
    appears = F.coalesce(F.lag("__step").over(by_zone) != F.col("__before"), F.lit(True)).cast("long")
    seen = seen.withColumn("__appears", appears).withColumn("__run", F.sum("__appears").over(by_zone))
    # Of the last run the newest step with data, or else the first.
    rank = F.struct("__run", "has_data", F.when(F.col("has_data"), F.col("__step")).otherwise(F.lit(-1) - F.col("__step")))
    chosen = seen.groupBy(*keys, "zone").agg(
        F.max_by("__step", rank).alias("__from"), F.max("__step").alias("__last"), F.max_by("place", "__step").alias("place")
    )
    newest = steps.groupBy(*keys).agg(F.max("__step").alias("__last"))
    chosen = chosen.join(newest, [*keys, "__last"]).drop("__last").withColumnRenamed("__from", "__step")
    return zones.join(chosen, [*keys, "zone", "__step"]).select(
        *keys, "place", "zone", "worksheet", "has_data", "panes", "story"
    )


def open_sessions(
    responses: DataFrame,
    keys: Sequence[str],
    step: str,
    payload: str,
    bootstrap: DataFrame | None = None,
    data: str = "data",
    info: str = "info",
) -> DataFrame:
    """(keys, sheet_no, worksheet, columns, dictionary) of every worksheet that a session shows
    after its responses, for ``decode_all`` and ``selectable_items``.

    ``responses`` has one row per (keys, step), ``step`` a number that orders them; the state
    after an earlier step is that of the responses up to it. ``bootstrap`` has the documents a
    session began with, at most one row per session. Zones with data are shown, or else those of
    the first story. Sessions without responses give no rows.
    """
    words = session_dictionary(responses, keys, step, payload, bootstrap, data)
    zones = session_zones(responses, keys, step, payload, bootstrap, info)
    state = zones.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("place", "worksheet", "has_data", "panes", "story"))).alias("__z")
    )
    sheet = lambda z: F.struct(z["worksheet"].alias("worksheet"), z["panes"].alias("panes"))
    shown = F.transform(F.filter("__z", lambda z: z["has_data"] & z["worksheet"].isNotNull()), sheet)
    story = F.get(F.filter("__z", lambda z: z["story"].isNotNull()), F.lit(0))["story"]
    state = state.select(*keys, shown.cast(_SHEET).alias("__shown"), story.cast(_SHEET).alias("__story"))
    state = state.select(*keys, F.when(F.size("__shown") > 0, F.col("__shown")).otherwise(F.col("__story")).alias("__sheets"))
    return _one_row_each(state.join(words, list(keys)), keys, F.lit(False))
