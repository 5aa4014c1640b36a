from __future__ import annotations

import datetime

import pytest

from gridtide.operators import cubes
from gridtide.schemas import CUBE
from sheets import FERRIES, FLEET, cells_of

D = datetime.date


def test_labelled_matrix(spark):
    cube = cubes.read_cube(cells_of(spark, m=FERRIES), metadata={"cat_no": "7600.0", "cube": " "})
    assert cube.columns == [*CUBE, "dims"]
    wide = cubes.dims_to_columns(cube, ["Route", "Day"]).orderBy("Route", "Day", "date").toPandas()
    assert list(zip(wide["Route"], wide["Day"])) == (
        [("North", "end")] * 4 + [("North", "week")] * 4 + [("South", "week")] * 4)
    assert list(wide["date"]) == [D(2044, m, 1) for m in (1, 2, 3, 4)] * 3
    assert wide["value"].isna().tolist() == [False] * 3 + [True] + [False] * 2 + [True] + [False] * 5
    assert list(wide["value"].dropna()) == [4, 5, 6, 10, 11, 13, 20, 21, 22, 23]  # nothing below the footer
    assert set(wide["frequency"]) == {"unknown"} and set(wide["cat_no"]) == {"7600.0"} and wide["cube"].isna().all()


def test_matrix_as_generic(spark):
    cube = cubes.read_cube(cells_of(spark, m=FERRIES), family="generic")
    rows = [r["dims"] for r in cube.collect()]
    assert len(rows) == 3 and all("Jan2044" in r and "Route" in r for r in rows)


def test_auto_takes_each_sheet_once(spark):
    sheets = {**FERRIES, **FLEET, "Crew": [["Name", "Age"], ["Ada", 40.0]]}
    found = cubes.read_cube(cells_of(spark, m=sheets)).toPandas()
    assert found.groupby("sheet").size().to_dict() == {"Fleet": 2, "Crew": 1, "Ferries": 12}
    with pytest.raises(ValueError):
        cubes.read_cube(cells_of(spark, m=sheets), family="unknown")


def test_footers(spark):
    sheets = {
        "A": [["Area", "N"], ["x", 1], [None, "Footnote 1"], ["y", 2]],
        "B": [["Area", "N", "M"], ["x", 1], ["some cells in", "this", "table are"], ["y", 2]],
        "C": [["Source", "N"], ["x source", 1], ["y", "Note: not first"], ["z", 3], ["© them"], ["w", 4]],
        "D": [["Area", "N"], ["x", 1], ["cells in this tab", "le"], ["y", 2]],
    }
    found = cubes.generic_records(cells_of(spark, f=sheets)).toPandas()
    last = found.groupby("sheet")["row_no"].max().to_dict()
    assert last == {"A": 2, "B": 2, "C": 4, "D": 4}


def test_notes_sheets(spark):
    sheets = {
        "Contents": [["a", "b"]], "Data": [["a", "b"]], "X": [[], [], ["Explanatory text"]],
        "Y": [["a"], ["b"], ["c"], ["Notes"]], "Z": [["a", "Notes"]], "Cover page": [["a"]],
        "W": [[], [], [], [], [], [], ["Title"], [None, "Notes to users"], ["x"]],
    }
    kept = cubes.without_notes(cells_of(spark, n=sheets)).select("sheet").distinct().collect()
    assert {r["sheet"] for r in kept} == {"Data", "Y", "Z"}


def test_raw_sheets_and_names(spark):
    sheets = {
        "S": [["Title"], [None, "A B", "A B", None, "A_B_2"], ["1", "x", "y", "z", "w"], [], ["2"]],
    }
    records = cubes.raw_records(cells_of(spark, r=sheets))
    names = {r["col_no"]: r["name"] for r in records.where("row_no = 3").collect()}
    assert names == {1: "Column1", 2: "A_B", 3: "A_B_2_2", 4: "Column4", 5: "A_B_2"}
    wide = cubes.to_wide(records, ["Column1", "A_B", "Column4"]).orderBy("row_no").toPandas()
    assert list(wide["row_no"]) == [3, 5] and list(wide["Column1"]) == ["1", "2"]
    first = cubes.raw_records(cells_of(spark, r=sheets), header_row=1)
    assert first.where("row_no = 2 and col_no = 2").first()["name"] == "Column2"


def test_period_column_must_have_a_label_to_its_left(spark):
    sheets = {
        "M": [["Mar-2024", "x"], [None, "2024-Q1"], ["State", "gap", "2024-Q2", "note", "2024-Q3"],
              ["NSW", None, 1, 50, 2], [None, "v", 3], [None, None, 4]],
    }
    found = cubes.matrix_cube(cells_of(spark, m=sheets)).toPandas()
    assert sorted(found["date"].unique()) == [D(2024, 4, 1), D(2024, 7, 1)]
    assert len(found) == 4 and set(found["frequency"]) == {"quarterly"}
    assert sorted(map(str, found["dims"])) == sorted(
        [str({"State": "NSW"})] * 2 + [str({"gap": "v"})] * 2)
