from __future__ import annotations

import datetime
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from gridtide.operators.cubes import read_cube
from gridtide.operators.timeseries import series_metadata, tidy
from gridtide.sources import workbooks
from gridtide.sources.wide import cells_from_csv, cells_from_wide
from gridtide.sources.workbooks import read_cells, read_errors, sheet_names
from gridtide.streaming import incremental
from gridtide.streaming.incremental import ingest_workbooks
from sheets import FERRIES, GAUGES
from xlsx import write_workbook

D = datetime.date


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "nested").mkdir()
    (tmp_path / "workbooks").mkdir()
    write_workbook(str(tmp_path / "first.xlsx"), GAUGES)
    write_workbook(str(tmp_path / "nested" / "second.XLSX"), GAUGES)
    write_workbook(str(tmp_path / "workbooks" / "cached.xlsx"), FERRIES)
    (tmp_path / "notes.txt").write_text("no workbook")
    return str(tmp_path)


def files(df):
    return {os.path.basename(r["source_file"]) for r in df.select("source_file").distinct().collect()}


def test_reading_workbooks(spark, lake):
    first = os.path.join(lake, "first.xlsx")
    found = tidy(read_cells(spark, first)).toPandas()
    assert found.groupby("sheet").size().to_dict() == {"Flow 3": 12, "Flow 11a": 3}
    assert set(found["sheet_no"]) == {1, 2}
    both = [first, os.path.join(lake, "nested", "second.XLSX")]
    assert tidy(read_cells(spark, both, tables=3)).count() == 24
    metadata = series_metadata(read_cells(spark, first, tables=3)).toPandas()
    assert len(metadata) == 4 and metadata["source_workbook"].str.endswith("first.xlsx").all()
    cube = read_cube(read_cells(spark, os.path.join(lake, "workbooks", "cached.xlsx")))
    assert cube.count() == 12


def test_directories(spark, lake):
    assert files(sheet_names(spark, lake)) == {"first.xlsx", "cached.xlsx"}
    assert files(sheet_names(spark, lake, recursive=True)) == {"first.xlsx", "cached.xlsx", "second.XLSX"}
    assert files(sheet_names(spark, [lake, os.path.join(lake, "first.xlsx")])) == {"first.xlsx", "cached.xlsx"}
    names = sheet_names(spark, os.path.join(lake, "first.xlsx")).orderBy("sheet_no").collect()
    assert [r["sheet"] for r in names] == ["Flow 3", "Flow 11a", "Legend"]
    os.mkdir(os.path.join(lake, "empty"))
    for bad in ([], [42], os.path.join(lake, "missing.xlsx"), os.path.join(lake, "notes.txt"),
                os.path.join(lake, "empty")):
        with pytest.raises(ValueError):
            read_cells(spark, bad)


def test_cell_types(spark, tmp_path):
    path = write_workbook(str(tmp_path / "t.xlsx"), {
        "T": [["inline:a & b", True, D(2024, 1, 1), 1.5, 45292], [], ["  ", "x", False]]})
    rows = read_cells(spark, path).orderBy("row_no", "col_no").collect()
    assert [(r["row_no"], r["col_no"], r["kind"], r["text"]) for r in rows] == [
        (1, 1, "s", "a & b"), (1, 2, "b", "true"), (1, 3, "d", "2024-01-01"), (1, 4, "n", "1.5"),
        (1, 5, "n", "45292"), (3, 2, "s", "x"), (3, 3, "b", "false")]
    assert rows[2]["period_date"] == D(2024, 1, 1) and rows[4]["period_date"] == D(2024, 1, 1)


def test_broken_files(spark, lake):
    with open(os.path.join(lake, "broken.xlsx"), "w") as f:
        f.write("not a workbook")
    errors = read_errors(spark, lake).collect()
    assert len(errors) == 1 and "broken.xlsx" in errors[0]["error"]
    assert files(read_cells(spark, lake, mode="permissive")) == {"first.xlsx", "cached.xlsx"}
    with pytest.raises(Exception, match="broken.xlsx"):
        read_cells(spark, lake).count()


def damaged(path, target, change):
    """A copy of a workbook with its parts changed: part name and content to content or None."""
    with zipfile.ZipFile(path) as old, zipfile.ZipFile(target, "w") as new:
        for name in old.namelist():
            content = change(name, old.read(name))
            if content is not None:
                new.writestr(name, content)


def test_whole_sheets_or_none(spark, tmp_path):
    rows = [["a", i, "b", "c"] for i in range(30)]
    path = write_workbook(str(tmp_path / "whole.xlsx"), {"One": rows, "Two": rows, "Three": []})

    def cut(name, content):
        return content[: len(content) // 2] if name.endswith("sheet2.xml") else content

    def beyond(name, content):
        return content.replace(b"<v>2</v></c></row></sheetData>", b"<v>9</v></c></row></sheetData>") if (
            name.endswith("sheet1.xml")) else content

    def no_strings(name, content):
        return None if "sharedStrings" in name else content

    damaged(path, str(tmp_path / "cut.xlsx"), cut)
    damaged(path, str(tmp_path / "beyond.xlsx"), beyond)
    damaged(path, str(tmp_path / "none.xlsx"), no_strings)
    cells, sheets = workbooks.parse_workbooks(workbooks.workbook_files(spark, str(tmp_path)))
    found = {(os.path.basename(r["source_file"]), r["sheet"]): (r["n_cells"], r["error"]) for r in sheets.collect()}
    assert found[("whole.xlsx", "One")] == (120, None) and found[("whole.xlsx", "Three")] == (0, None)
    assert {k for k, v in found.items() if v[1]} == {
        ("cut.xlsx", "Two"), ("beyond.xlsx", "One"), ("none.xlsx", "One"), ("none.xlsx", "Two")}
    assert "no shared string 9" in found[("beyond.xlsx", "One")][1]
    counts = {(os.path.basename(r["source_file"]), r["sheet"]): r["count"]
              for r in cells.groupBy("source_file", "sheet").count().collect()}
    assert counts == {("whole.xlsx", "One"): 120, ("whole.xlsx", "Two"): 120, ("cut.xlsx", "One"): 120,
                      ("beyond.xlsx", "Two"): 120}
    errors = read_errors(spark, str(tmp_path)).collect()
    assert sorted(r["sheet"] for r in errors) == ["One", "One", "Two", "Two"]


def test_a_broken_dictionary_breaks_the_sheets_that_use_it(spark, tmp_path):
    path = write_workbook(str(tmp_path / "ok.xlsx"), {"Words": [["a", "b"]], "Numbers": [[1, 2]]})
    damaged(path, str(tmp_path / "bad.xlsx"), lambda n, c: c[:-20] if "sharedStrings" in n else c)
    os.remove(path)
    cells, sheets = workbooks.parse_workbooks(workbooks.workbook_files(spark, str(tmp_path)))
    assert {r["sheet"]: r["error"] is None for r in sheets.collect()} == {"Words": False, "Numbers": True}
    assert [r["sheet"] for r in cells.collect()] == ["Numbers", "Numbers"]


def test_strings_are_written_once_whatever_the_number_of_sheets(spark, tmp_path):
    words = [[f"a rather long text number {i}"] for i in range(200)]
    sizes = []
    for n in (1, 6):
        path = write_workbook(str(tmp_path / f"{n}.xlsx"), {f"S{i}": words for i in range(n)})
        files = workbooks.workbook_files(spark, path)
        strings = workbooks.shared_strings(files).where("string_no is not null")
        assert strings.count() == 200
        dealt = workbooks.sheet_rows(files)
        assert "rather long" not in "".join(bytes(r["xml"]).decode() for r in dealt.collect())
        sizes.append(strings.agg(F.sum(F.length("text"))).first()[0])
        plan = workbooks.raw_cells(files)._jdf.queryExecution().executedPlan().toString()
        exchange = next(line for line in plan.splitlines() if "Exchange" in line)
        assert "strings" not in exchange
    assert sizes[0] == sizes[1]


def test_only_named_folders_are_listed(spark, lake):
    os.makedirs(os.path.join(lake, "odd [x]", "deep"))
    write_workbook(os.path.join(lake, "odd [x]", "a{b}.xlsx"), GAUGES)
    write_workbook(os.path.join(lake, "odd [x]", "deep", "c.xlsx"), GAUGES)
    loaded = workbooks.workbook_files(spark, [lake, os.path.join(lake, "odd [x]")]).inputFiles()
    assert sorted(os.path.basename(f) for f in loaded) == ["a%7Bb%7D.xlsx", "cached.xlsx", "first.xlsx"]
    both = workbooks.workbook_files(spark, [lake, os.path.join(lake, "odd [x]")], recursive=True)
    assert both.count() == 5  # a folder inside another one is not read twice
    assert files(sheet_names(spark, os.path.join(lake, "odd [x]"))) == {"a{b}.xlsx"}


def manifest(spark, store):
    rows = incremental.manifest_of(spark, store).collect()
    return {os.path.basename(r["path"]): r for r in rows}


def test_incremental_ingest(spark, lake):
    store = os.path.join(lake, "store")

    def batches():
        return {p for p in os.listdir(os.path.join(store, "cells")) if p.startswith("batch=")}

    cells = ingest_workbooks(spark, lake, store)
    total, first = cells.count(), batches()
    assert files(cells) == {"first.xlsx", "cached.xlsx"} and len(first) == 1
    assert ingest_workbooks(spark, lake, store).count() == total and batches() == first
    write_workbook(os.path.join(lake, "first.xlsx"), {"Data1": [["Series ID", "R70001K"], ["2034", 1]]})
    changed = ingest_workbooks(spark, lake, store)
    # The changed file has a new fingerprint, the stored old version stays but is not read.
    assert len(batches()) == 2 and changed.where("source_file like '%first%'").count() == 4
    now = changed.count()
    assert ingest_workbooks(spark, lake, store, refresh=True).count() == now
    assert len(batches()) == 3


def test_first_scan_lists_second_scan_reads_what_is_pending(spark, lake):
    store, opened = os.path.join(lake, "store"), []

    def contents(paths):
        opened.append(sorted(os.path.basename(p) for p in paths))
        found = workbooks.open_workbooks(spark, paths)
        assert sorted(os.path.basename(f) for f in found.inputFiles()) == opened[-1]
        return found

    def listing():
        rows = workbooks.workbook_files(spark, lake).drop("content")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema" in plan and "content" not in plan.split("ReadSchema")[1]
        return rows

    write_workbook(os.path.join(lake, "empty.xlsx"), {"Nothing": []})
    write_workbook(os.path.join(lake, "bare.xlsx"), {})
    with open(os.path.join(lake, "broken.xlsx"), "w") as f:
        f.write("not a workbook")
    incremental.ingest(spark, listing(), contents, store, batch_files=3)
    assert sorted(map(len, opened)) == [2, 3]
    found = manifest(spark, store)
    assert set(found) == {"first.xlsx", "cached.xlsx", "empty.xlsx", "bare.xlsx", "broken.xlsx"}
    assert (found["empty.xlsx"]["n_sheets"], found["empty.xlsx"]["n_cells"]) == (1, 0)
    assert (found["bare.xlsx"]["n_sheets"], found["bare.xlsx"]["n_errors"]) == (0, 0)
    assert found["broken.xlsx"]["n_errors"] == 1 and "broken.xlsx" in found["broken.xlsx"]["error"]
    opened.clear()
    incremental.ingest(spark, listing(), contents, store)
    assert opened == []  # also the empty and the broken ones
    write_workbook(os.path.join(lake, "empty.xlsx"), {"Now": [["x"]]})
    incremental.ingest(spark, listing(), contents, store)
    assert opened == [["empty.xlsx"]]


def test_a_batch_that_dies_before_its_manifest_rows_is_read_again(spark, lake, monkeypatch):
    store = os.path.join(lake, "store")
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest_workbooks(spark, lake, store)
    assert os.listdir(os.path.join(store, "cells"))
    again = ingest_workbooks(spark, lake, store)
    whole = read_cells(spark, lake)
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.select(again.columns).collect()))


def test_tables_as_cells(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None, True), (2, " ", 2.5, False)], "id int, `a b` string, v double, f boolean")
    cells = cells_from_wide(df, "f", 1, "S", F.col("id")).orderBy("row_no", "col_no").collect()
    assert [(r["row_no"], r["col_no"], r["kind"], r["text"]) for r in cells] == [
        (1, 1, "s", "id"), (1, 2, "s", "a b"), (1, 3, "s", "v"), (1, 4, "s", "f"),
        (2, 1, "n", "1"), (2, 2, "s", "x"), (2, 4, "b", "true"),
        (3, 1, "n", "2"), (3, 3, "n", "2.5"), (3, 4, "b", "false")]
    path = tmp_path / "t.csv"
    path.write_text('Title line\nSeries ID,A1234567\nUnit,"a, b"\n2024-01,1\n2024-02,\n2024-03,3\n')
    found = tidy(cells_from_csv(spark, str(path))).orderBy("date").collect()
    assert [(r["date"].month, r["value"], r["frequency"]) for r in found] == [
        (1, 1.0, "monthly"), (2, None, "monthly"), (3, 3.0, "monthly")]
    assert {(r["unit"], r["series_id"]) for r in found} == {("a, b", "A1234567")}


def test_csv_rows_keep_their_order_over_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("".join(f"{i},v{i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        cells = cells_from_csv(spark, str(path)).where("col_no = 1")
        wrong = cells.where(F.col("row_no").cast("string") != F.col("text")).count()
        assert (cells.count(), wrong) == (5000, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
