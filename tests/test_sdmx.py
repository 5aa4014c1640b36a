from __future__ import annotations

import datetime

import pytest

from gridtide.operators import sdmx
from gridtide.schemas import DATASTRUCTURE

D = datetime.date
# Documents of an invented port authority. Positions have gaps, two dimensions share a code list.
PORT = """{"meta": {"id": "x"}, "data": {"codelists": [
 {"id": "CL_BERTH", "items": [{"id": "N1", "name": {"en": "North quay"}}, {"id": "N2", "name": {"en": "North-east quay"}},
                              {"id": "S1", "name": {"en": "South quay"}}, {"id": "T", "name": {"en": "All quays"}}]},
 {"id": "CL_CARGO", "items": [{"id": "7", "name": {"en": "Grain"}}, {"id": "8", "name": {"en": "Timber"}}]},
 {"id": "CL_UNUSED", "items": [{"id": "z"}]}],
 "dataStructures": [{"id": "DSD_PORT", "dataStructureComponents": {"dimensionList": {"id": "list", "dimensions": [
 {"id": "BERTH", "name": {"en": "Berth used"}, "position": 1, "localRepresentation": {"enumeration": {"id": "CL_BERTH"}}},
 {"id": "LOADED", "name": {"en": "Cargo loaded"}, "position": 3, "localRepresentation": {"enumeration": {"id": "CL_CARGO"}}},
 {"id": "UNLOADED", "name": {"en": "Cargo unloaded"}, "position": 4, "localRepresentation": {"enumeration": {"id": "CL_CARGO"}}},
 {"id": "PILOT", "name": {"en": "Pilot"}, "position": 6}]}}}]}}"""
#: codes of the same names stand for other things here
RIVER = PORT.replace('"id": "7", "name": {"en": "Grain"}', '"id": "7", "name": {"en": "Timber"}').replace(
    '"id": "8", "name": {"en": "Timber"}', '"id": "8", "name": {"en": "Sand"}')
# Dimensions in a plain list, out of order, one of them without a code list; lists of codes with
# plain labels, one code without any.
BY_REF = """{"sea": {"state": {"dimensions": [
 {"id": "WIND", "name": "Wind", "position": 8, "localRepresentation": {"enumeration": {"ref": "CL_WIND"}}},
 {"id": "LOG", "name": "Log", "position": "3"},
 {"id": "TIDE", "name": "Tide", "position": "0", "localRepresentation": {"enumeration": {"ref": "CL_TIDE"}}}]}},
 "codelists": [{"id": "CL_WIND", "codes": [{"id": "NE"}, {"id": "SW", "name": "South-west"}]},
               {"id": "CL_TIDE", "codes": [{"id": "H", "name": "High"}, {"id": "L", "name": "Low"}, {"id": "S", "name": "Slack"}]}]}"""
# Codes written inside the dimensions, some of which also refer to a list that isn't there.
INLINE = """{"structure": {"dimensions": {
 "series": [{"id": "CREW", "name": "Crew", "localRepresentation": {"enumeration": {"id": "CL_NONE"}}},
            {"id": "SHIFT", "name": {"en": "Shift"}, "values": [{"id": "am"}, {"id": "pm"}, {"id": "night", "name": "Night"}]},
            {"id": "DOCK", "name": {"en": "Dock"}, "values": [{"id": "d1", "name": {"en": "Dry dock"}}],
             "localRepresentation": {"enumeration": {"id": "CL_NONE"}}}],
 "observation": []}}}"""


def wrapped(document, levels):
    """A document below so many objects and lists in turn."""
    for i in range(levels):
        document = f'{{"layer{i}": {document}}}' if i % 2 else f'[{document}]'
    return document


def documents(spark, **json):
    return spark.createDataFrame(list(json.items()), "doc_id string, json string")


@pytest.fixture(scope="module")
def structure(spark):
    docs = documents(spark, port=PORT, river=RIVER, ref=BY_REF, inline=INLINE, bad="{",
                     deep=wrapped(BY_REF, 21))
    return sdmx.datastructure(docs).cache()


def test_datastructure(structure):
    assert structure.columns == ["doc_id", *DATASTRUCTURE]
    rows = sdmx.ordered_structure(structure.where("doc_id = 'port'")).collect()
    assert [(r["dimension_id"], r["code"], r["code_position"]) for r in rows] == [
        ("BERTH", "N1", 1), ("BERTH", "N2", 2), ("BERTH", "S1", 3), ("BERTH", "T", 4),
        ("LOADED", "7", 1), ("LOADED", "8", 2), ("UNLOADED", "7", 1), ("UNLOADED", "8", 2),
        ("PILOT", None, None)]
    assert [r["label"] for r in rows[4:6]] == ["Grain", "Timber"]
    assert [r["position"] for r in rows if r["code"] in ("N1", None)] == [2, 7]
    ref = sdmx.ordered_structure(structure.where("doc_id = 'ref'")).collect()
    assert [tuple(r)[1:] for r in ref] == [
        ("TIDE", "Tide", 1, "H", "High", 1), ("TIDE", "Tide", 1, "L", "Low", 2), ("TIDE", "Tide", 1, "S", "Slack", 3),
        ("LOG", "Log", 4, None, None, None),
        ("WIND", "Wind", 9, "NE", None, 1), ("WIND", "Wind", 9, "SW", "South-west", 2)]
    deep = sdmx.ordered_structure(structure.where("doc_id = 'deep'")).collect()
    assert [tuple(r)[1:] for r in deep] == [tuple(r)[1:] for r in ref]
    inline = structure.where("doc_id = 'inline'").orderBy("position", "code_position").collect()
    assert [(r["dimension_id"], r["code"], r["position"]) for r in inline] == [
        ("CREW", None, 1), ("SHIFT", "am", 2), ("SHIFT", "pm", 2), ("SHIFT", "night", 2), ("DOCK", "d1", 3)]
    assert structure.where("doc_id = 'bad'").count() == 0


def test_keys(structure):
    port = structure.where("doc_id = 'port'")
    assert sdmx.api_key(port, {"berth": "t", "loaded": "7"}) == "T.7.."
    assert sdmx.api_key(port, {"Berth used": "North-east quay", "UNLOADED": "grain"}) == "N2..7."
    assert sdmx.api_key(port, {"cargo loaded": "timber", "berth": ["S1", "n1"]}) == "S1+N1.8.."
    assert sdmx.api_key(port) == "all"
    assert sdmx.api_key(port, {"pilot": "any name"}) == "...any name"
    for bad in ({"depth": "1"}, {"berth": "N9"}, ["no mapping"]):
        with pytest.raises(ValueError):
            sdmx.api_key(port, bad)
    with pytest.raises(ValueError, match="several"):
        sdmx.api_key(structure, {"berth": "T"})
    examples = sdmx.code_examples(port, 3).where("dimension_id = 'BERTH'").orderBy("rank").collect()
    assert [r["code"] for r in examples] == ["N1", "N2", "S1"]


def test_later_filter_on_a_dimension_wins(structure):
    port = structure.where("doc_id = 'port'")
    assert sdmx.api_key(port, {"berth": "S1", "berth_used": "T"}) == "T..."


DATA = """{"structure": {"dimensions": {
 "series": [{"id": "LOADED", "values": [{"id": "7"}, {"id": "8"}]}, {"id": "BERTH", "values": [{"id": "S1"}, {"id": "T"}]}],
 "observation": [{"id": "TIME_PERIOD", "values": [{"id": "2041-Q3"}, {"id": "2041-Q4"}, {"id": "2042-Q1"}]}]}},
 "dataSets": [{"series": {"0:1": {"observations": {"0": ["61.5", "e"], "2": [63]}},
                          "1:0": {"observations": {"1": [8]}}}}]}"""
# Keys that name no code and too few of them, observations without or with odd values.
ODD = """{"structure": {"dimensions": {
 "series": [{"id": "DOCK", "values": [{"id": "d1"}, {"id": "d2"}]}, {"id": "CREW", "values": [{"id": "c1"}]}],
 "observation": [{"id": "YEAR", "values": [{"id": "2041"}, {"id": "2042"}]}]}},
 "dataSets": [{"series": {"1:5": {"observations": {"0": [], "1": ["4"], "6": ["n/a"]}},
                          "0": {"observations": {"late": [7]}}}}]}"""
FLAT = """{"structure": {"dimensions": {"observation": [{"id": "DOCK", "values": [{"id": "d1"}, {"id": "d2"}]},
 {"id": "time", "values": [{"id": "2043-05"}, {"id": "2043-06"}]}]}}, "dataSets": [{"observations": {"1:1": [5, 0], "4:0": [6]}}]}"""
TWICE = """{"structure": {"dimensions": {"series": [{"id": "DOCK", "values": [{"id": "outer"}]}],
 "observation": [{"id": "DOCK", "values": [{"id": "inner"}]}]}},
 "dataSets": [{"series": {"0": {"observations": {"0": ["2,500"]}}}}]}"""


def test_observations(spark):
    docs = documents(spark, data=DATA, odd=ODD, empty='{"dataSets": []}', flat=FLAT, twice=TWICE)
    rows = {}
    for row in sdmx.observations(docs).orderBy("doc_id", "period").collect():
        rows.setdefault(row["doc_id"], []).append(tuple(row)[1:])
    assert rows == {
        "data": [("2041-Q3", D(2041, 7, 1), 61.5, {"LOADED": "7", "BERTH": "T", "TIME_PERIOD": "2041-Q3"}),
                 ("2041-Q4", D(2041, 10, 1), 8.0, {"LOADED": "8", "BERTH": "S1", "TIME_PERIOD": "2041-Q4"}),
                 ("2042-Q1", D(2042, 1, 1), 63.0, {"LOADED": "7", "BERTH": "T", "TIME_PERIOD": "2042-Q1"})],
        "odd": [("0", None, None, {"YEAR": "2041", "DOCK": "d2"}), ("1", None, 4.0, {"YEAR": "2042", "DOCK": "d2"}),
                ("6", None, None, {"DOCK": "d2"}), ("late", None, 7.0, {"DOCK": "d1"})],
        "flat": [("2043-05", D(2043, 5, 1), 6.0, {"time": "2043-05"}),
                 ("2043-06", D(2043, 6, 1), 5.0, {"DOCK": "d2", "time": "2043-06"})],
        "twice": [("0", None, 2500.0, {"DOCK": "inner"})],
    }


def test_filtering_observations(spark, structure):
    df = sdmx.observations(documents(spark, port=DATA, river=DATA))
    both = structure.where("doc_id in ('port', 'river')")
    # "Timber" is 8 in the one document and 7 in the other
    found = sdmx.filter_observations(df, both, {"loaded": "timber"}).collect()
    assert sorted((r["doc_id"], r["period"]) for r in found) == [
        ("port", "2041-Q4"), ("river", "2041-Q3"), ("river", "2042-Q1")]
    assert sdmx.filter_observations(df, both, {"berth": ["all quays", "s1"], "loaded": "7"}).count() == 4
    assert sdmx.filter_observations(df, both, {"berth": ""}).count() == 6
    assert sdmx.filter_observations(df, both, {"unloaded": "7"}).count() == 0
    assert sdmx.filter_observations(df, both, {}, start_period="2041-Q4").count() == 4
    assert sdmx.filter_observations(df, both, {}, end_period="2041-Q3").count() == 2
    assert sdmx.filter_observations(df, both, {}, "2041", "2041").count() == 4
    one = sdmx.observations(documents(spark, any=DATA)).drop("doc_id")
    assert sdmx.filter_observations(one, structure.where("doc_id = 'river'"), {"loaded": "sand"}).count() == 1
    with pytest.raises(ValueError, match="doc_id"):
        sdmx.filter_observations(one, both, {"loaded": "timber"})
    with pytest.raises(ValueError):
        sdmx.filter_observations(df, both, {"colour": "red"})


def test_dataflows(spark):
    landed = """{"dataflows": [{"id": "TUGS", "name": {"en": "Tugs", "fr": "x"}, "description": "Tugs at work"},
     {"name": {"en": "Without id"}}, {"id": "", "name": "Empty id"}]}"""
    under = {f"level{n}": wrapped(f'{{"Dataflows": {{"k": {{"id": "F{n}", "name": "Flow {n}"}}}}}}', n) for n in range(1, 20)}
    twice = '{"a": {"dataflows": [{"id": "TUGS", "name": "Tugs", "description": "Tugs at work"}]}}'
    found = sdmx.dataflows(documents(spark, landed=landed, twice=twice, **under)).collect()
    assert sorted(map(tuple, found)) == sorted(
        [("TUGS", "Tugs", "Tugs at work"), *((f"F{n}", f"Flow {n}", "") for n in range(1, 20))])
