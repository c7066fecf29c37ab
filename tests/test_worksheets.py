"""Decoding without names, and folding the responses of sessions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cotejo.operators import worksheets as ws
from test_dashboard import EARLY, bootstrap, column, described, one, response, zone


def cells(df):
    return {(r.worksheet, r.row_no, r.column_no, r.column): r.value for r in df.collect()}


def frame(names_and_values):
    """Expected cells of one worksheet: short columns are filled."""
    longest = max((len(v) for v in names_and_values.values()), default=0)
    return {
        (i, n, name): (values[i] if i < len(values) and values[i] is not None else "0")
        for n, (name, values) in enumerate(names_and_values.items())
        for i in range(longest)
    }


def sheet(name, names_and_values):
    return {(name, *k): v for k, v in frame(names_and_values).items()}


def test_every_column_of_every_worksheet(spark):
    opened = ws.open_payloads(one(spark, bootstrap()), ["id"], "payload")
    want = sheet("Harvest", {"Orchard-value": ["north", "south", "north"], "Fruit-alias": ["pear", "apple", "quince"]})
    assert cells(ws.decode_all(opened, ["id"])) == want


def test_equal_names_short_columns_and_unknown_types(spark):
    panes = {
        "paneColumnsList": [{"vizPaneColumns": [
            column(values=[0, 1, 2, 9]), column(values=[1], aliases=[-1]), column(values=[2, 3]), column(values=[4]),
            column(), column(values=[0, 1, 2, 3, 4]),
        ]}],
        "vizDataColumns": [
            described("A", "cstring", 0), described("A", "real", 1, fn="SUM"), described("A", "date", 2, fn="SUM"),
            described("B", "cstring", 3), described("C", "cstring", 4), described("", "cstring", 5),
        ],
    }
    opened = ws.open_payloads(one(spark, bootstrap(panes)), ["id"], "payload")
    want = sheet("Harvest", {"A-value": EARLY[:3], "A-SUM-value": ["plum" if v == 3 else EARLY[v] for v in (2, 3)], "A-alias": ["north"], "B-value": ["fig"]})
    # The third column has the name of the second: its values stand in the second's place.
    assert cells(ws.decode_all(opened, ["id"])) == want


def test_rows_without_a_document(spark):
    df = spark.createDataFrame([(1, None), (2, "{"), (3, "{}"), (4, bootstrap())], "id int, payload string")
    assert {r.id for r in ws.decode_all(ws.open_payloads(df, ["id"], "payload"), ["id"]).collect()} == {4}
    df = df.withColumn("payload", F.when(F.col("id") == 4, response({"7": zone("W")})).otherwise(F.col("payload")))
    assert {r.id for r in ws.decode_all(ws.open_responses(df, ["id"], "payload"), ["id"]).collect()} == {4}


def test_story_sheets(spark):
    story = {"9": {"presModelHolder": {"flipboard": {"storyPoints": {"1": {"dashboardPresModel": {"zones": {"3": zone("Told"), "4": zone("More")}}}}}}}}
    opened = ws.open_responses(one(spark, response(story)), ["id"], "payload")
    assert {r.worksheet for r in ws.decode_all(opened, ["id"]).collect()} == {"Told", "More"}
    both = ws.open_responses(one(spark, response({"1": zone("Own"), **story})), ["id"], "payload")
    assert [r.worksheet for r in both.collect()] == ["Own"]


def test_one_parse_and_no_shuffle(spark):
    opened = ws.open_payloads(one(spark, bootstrap()), ["id"], "payload")
    plan = ws.decode_all(opened, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "Exchange" not in plan


def test_selectable_items(spark):
    opened = ws.open_payloads(one(spark, bootstrap()), ["id"], "payload")
    got = {(r.worksheet, r.column_no, r.column): r["values"] for r in ws.selectable_items(opened, ["id"]).collect()}
    assert got == {("Harvest", 0, "Orchard"): ["north", "south", "north"], ("Harvest", 1, "Fruit"): ["pear", "apple", "quince"]}


def test_download_reads_the_session_first(spark):
    flat = lambda caption, kind, **p: {"fieldCaption": caption, "valueIndices": [], "aliasIndices": [], "dataType": kind, **p}
    table = {
        "dataDictionary": {"dataSegments": {"0": {"dataColumns": [{"dataType": "cstring", "dataValues": ["stale"]}]}, "5": {"dataColumns": [{"dataType": "cstring", "dataValues": ["new"]}]}}},
        "underlyingDataTableColumns": [flat("A", "cstring", valueIndices=[0, 1]), flat("B", "cstring", aliasIndices=[-2]), flat("", "cstring", valueIndices=[0])],
    }
    text = json.dumps({"vqlCmdResponse": {"cmdResultList": [{"commandReturn": {"underlyingDataTable": table}}]}})
    df = one(spark, text).withColumn("known", F.from_json(F.lit('{"0": {"dataColumns": [{"dataType": "cstring", "dataValues": ["old"]}]}}'), ws.dashboard.SEGMENTS))
    got = ws.decode_download(df, ["id"], "payload", ["B-alias", "A-value"], persisted="known").orderBy("row_no").collect()
    assert [(r["A-value"], r["B-alias"]) for r in got] == [("old", "new"), ("new", "0")]
    long = ws.decode_all(ws.open_downloads(df, ["id"], "payload", "known"), ["id"])
    assert cells(long) == sheet(None, {"A-value": ["old", "new"], "B-alias": ["new"]})
    assert ws.open_downloads(one(spark, "{}"), ["id"], "payload").count() == 0


# Sessions


def segment(*words):
    return {"dataColumns": [{"dataType": "cstring", "dataValues": list(words)}]}


def picture(name, positions, **more):
    panes = {"paneColumnsList": [{"vizPaneColumns": [column(values=positions)]}], "vizDataColumns": [described("C", "cstring", 0)]}
    return zone(name, panes, **more)


def bare(name):
    return {"worksheet": name, "presModelHolder": {"visual": {"other": 1}}}


def told(*sheets):
    points = {"1": {"dashboardPresModel": {"zones": {str(i): s for i, s in enumerate(sheets)}}}}
    return {"presModelHolder": {"flipboard": {"storyPoints": points}}}


class Session:
    """What a browser keeps between responses, one response at a time."""

    def __init__(self):
        self.words, self.zones = {}, {}

    def take(self, segments, zones):
        for key, value in segments.items():
            if value is not None:
                self.words[key] = value
        kept = {}
        for key, new in zones.items():
            if new is None:
                continue
            has_data = "vizData" in new["presModelHolder"].get("visual", {})
            kept[key] = self.zones[key] if not has_data and key in self.zones else new
        self.zones = kept

    def shown(self):
        listed = [v for s in self.words.values() for v in s["dataColumns"][0]["dataValues"]]
        has_data = lambda z: "worksheet" in z and "vizData" in z["presModelHolder"].get("visual", {})
        sheets = [z for z in self.zones.values() if has_data(z)]
        if not sheets:
            stories = [z["presModelHolder"]["flipboard"]["storyPoints"] for z in self.zones.values() if "flipboard" in z["presModelHolder"]]
            if stories:
                sheets = [z for z in stories[0]["1"]["dashboardPresModel"]["zones"].values() if has_data(z)]
        out = {}
        for z in sheets:
            positions = z["presModelHolder"]["visual"]["vizData"]["paneColumnsData"]["paneColumnsList"][0]["vizPaneColumns"][0]["valueIndices"]
            out.update(sheet(z["worksheet"], {"C-value": [listed[p] for p in positions if p < len(listed)]}))
        return out


def random_session(rng, n):
    """Steps of (segments, zones): segments come interleaved and again, zones come and go."""
    steps = []
    for step in range(n):
        segments = {str(k): None if rng.random() < 0.2 else segment(*(f"{step}.{k}.{i}" for i in range(rng.integers(1, 4)))) for k in rng.permutation(5)[: rng.integers(0, 4)]}
        zones = {}
        for k in rng.permutation(4):
            kind = rng.integers(5)
            if kind == 1:
                zones[str(k)] = None
            elif kind == 2:
                zones[str(k)] = bare(f"W{k}")
            elif kind >= 3:
                zones[str(k)] = picture(f"W{k}", rng.integers(0, 8, 3).tolist())
        if rng.random() < 0.3:
            zones["s"] = told(picture(f"S{step}", [0, 1]), bare("none"))
        steps.append((segments, zones))
    return steps


@pytest.mark.parametrize("with_bootstrap", [False, True])
def test_sessions_as_a_browser_keeps_them(spark, with_bootstrap):
    rng = np.random.default_rng(3)
    rows, begun, want = [], [], {}
    for s in range(40):
        session, steps = Session(), random_session(rng, int(rng.integers(1, 7)))
        if with_bootstrap and s % 3:
            (segments, zones), = random_session(rng, 1)
            session.take(segments, zones)
            info = json.dumps({"worldUpdate": {"applicationPresModel": {"workbookPresModel": {"dashboardPresModel": {"zones": zones}}}}})
            begun.append((s, bootstrap(segments=segments), info))
        for segments, zones in steps:
            session.take(segments, zones)
        rows += [(s, 10 * i - 5, response(zones, segments)) for i, (segments, zones) in enumerate(steps)]
        want.update({(s, *k): v for k, v in session.shown().items()} if session.words else {})
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(s), int(i), p) for s, i, p in rows], "session long, step long, payload string")
    first = spark.createDataFrame(begun, "session long, data string, info string") if with_bootstrap else None
    got = ws.decode_all(ws.open_sessions(df, ["session"], "step", "payload", first), ["session"]).collect()
    assert len(want) > 100
    assert {(r.session, r.worksheet, r.row_no, r.column_no, r.column): r.value for r in got} == want


def test_interleaving_segments_keep_their_place(spark):
    zones = {"1": picture("W", [0, 1, 2, 3])}
    steps = [({"b": segment("b0", "b1")}, zones), ({"a": segment("a0")}, zones), ({"b": segment("b2"), "c": segment("c0")}, zones)]
    df = spark.createDataFrame([(1, i, response(z, s)) for i, (s, z) in enumerate(steps)], "session int, step int, payload string")
    got = ws.decode_all(ws.open_sessions(df, ["session"], "step", "payload"), ["session"])
    assert [r.value for r in got.orderBy("row_no").collect()] == ["b2", "a0", "c0"]


def test_sessions_parse_only_the_parts_they_read(spark):
    df = spark.createDataFrame([("s", 1, "{}")], "session string, step long, payload string")
    lines = ws.open_sessions(df, ["session"], "step", "payload")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    parsed = [line for line in lines if "from_json" in line]
    assert len(parsed) == 3
    assert sum("dataValues" in p for p in parsed) == 1 and sum("vizPaneColumns" in p for p in parsed) == 1
