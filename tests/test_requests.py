"""Containment, joins with hot keys, file requests, nearest releases, requests to observations."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gridtide.operators import catalogue, requests
from gridtide.operators.containment import containing, spread_join
from gridtide.operators.tables import match_tables
from gridtide.schemas import FILE_INDEX

D = datetime.date


def test_containing_against_all_pairs(spark):
    rng = random.Random(1)
    texts = [(rng.choice("xy"), "".join(rng.choices("abc é", k=rng.randrange(9)))) for _ in range(80)]
    needles = [(rng.choice("xyz"), "".join(rng.choices("abc é", k=rng.randrange(5)))) for _ in range(60)]
    got = containing(
        spark.createDataFrame([*texts, ("x", None)], "kind string, text string"),
        spark.createDataFrame([*needles, ("x", None)], "kind string, needle string"), ["kind"],
    )
    want = {(k, t, n) for k, t in texts for j, n in needles if k == j and n and n in t}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Join Cross" not in plan


def test_hot_keys_are_spread(spark):
    many = spark.range(1000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id"
    )
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("9", 3), ("none", 4)], "key string, value int")
    got = spread_join(many, few, "key", 50)
    assert got.count() == 2 * 900 + 1 and got.columns == ["key", "id", "value"]
    assert got.exceptAll(many.join(few, "key").select(got.columns)).isEmpty()


def test_table_requests_with_one_token_in_most_names(spark):
    names = [f"Table 1 part {i}" for i in range(100, 190)] + ["Table 2", "Index", "Table 1a", "notes index"]
    asked = ["1", "table 1", "Index", "2", "dex", " ", "1a"]
    sheets = spark.createDataFrame([(n,) for n in names], "sheet string")
    wanted = spark.createDataFrame([(r,) for r in asked], "request string")
    plain = {(r["sheet"], r["request"]) for r in match_tables(sheets, wanted).collect()}
    spread = {(r["sheet"], r["request"]) for r in match_tables(sheets, wanted, hot_rows=7).collect()}
    assert plain == spread
    assert sum(request == "1" for _, request in plain) == 90
    assert {s for s, request in plain if request == "dex"} == {"Index", "notes index"}
    assert {s for s, request in plain if request in ("2", "1a")} == {"Table 2", "Table 1a"}


def row(cat_no, title, filename, release, table_no=None, cube=False):
    values = dict.fromkeys(FILE_INDEX.names)
    values.update(cat_no=cat_no, file_title=title, filename=filename, release_date=release, table_no=table_no,
                  is_timeseries=not cube, is_cube=cube)
    return tuple(values[n] for n in FILE_INDEX.names)


@pytest.fixture(scope="module")
def index(spark):
    rows = [
        row("7001.0", "Table 1. Rainfall by basin", "rain1.xlsx", "mar-2031", "1"),
        row("7001.0", "Table 12. Snowfall", "snow.xlsx", "mar-2031", "12"),
        row("7001.0", "Table 1. Rainfall by basin", "rain0.xlsx", "dec-2030", "1"),
        row("7001.0", "Hail", "hail cube.xlsx", "sep-2030", None, True),
        row("7002.0", None, "plain.xlsx", None),
    ]
    return spark.createDataFrame(rows, FILE_INDEX)


def test_select_files(spark, index):
    asked = [
        (1, "7001.0", None, None, None, False), (2, "7001.0", "RAIN", None, None, False),
        (3, "7001.0", "12", None, None, False), (4, "7001.0", "fall", "dec-2030", None, False),
        (5, "7001.0", "w.x", None, None, False), (6, "7001.0", " ", None, None, False),
        (7, "7001.0", None, None, D(2030, 12, 24), False), (8, "7001.0", "rain", None, D(2031, 2, 1), False),
        (9, "7001.0", None, None, None, True), (10, "7009.0", "x", None, None, False),
        (11, "7002.0", "plain", None, None, False), (12, "7001.0", "sleet", None, None, False),
    ]
    wanted = spark.createDataFrame(
        asked, "request_id int, cat_no string, file string, release string, release_day date, cube boolean")
    got = {r["request_id"]: (r["filename"], r["error"]) for r in catalogue.select_files(index, wanted).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        1: "rain1.xlsx", 2: "rain1.xlsx", 3: "snow.xlsx", 4: "rain0.xlsx", 5: "snow.xlsx", 6: "rain1.xlsx",
        7: "rain0.xlsx", 8: None, 9: "hail cube.xlsx", 10: None, 11: "plain.xlsx", 12: None}
    assert got[8][1] == (
        "release 2031-02-01 is not available; nearest known releases: 2031-03-01, 2030-12-01, 2030-09-01")
    assert (got[10][1], got[12][1]) == ("no files for catalogue", "no file matched")


def test_strict_release_files(spark, index):
    asked = spark.createDataFrame(
        [("7001.0", D(2031, 3, 1)), ("7001.0", D(2029, 1, 1)), ("7777.0", D(2031, 3, 1))],
        "cat_no string, release_month date")
    assert catalogue.release_files(index, asked).count() == 2
    strict = catalogue.release_files(index, asked, strict=True)
    errors = {(r["cat_no"], r["error"]) for r in strict.where("error is not null").collect()}
    assert strict.count() == 4 and errors == {
        ("7001.0", "release 2029-01-01 is not available; nearest known releases: 2030-09-01, 2030-12-01, 2031-03-01"),
        ("7777.0", "release 2031-03-01 is not available; no releases are known")}


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_releases_against_sorting(spark, k):
    rng = random.Random(k)

    def day():
        return D(2030, 1, 1) + datetime.timedelta(days=rng.randrange(90))

    known = [(rng.choice("ab"), day()) for _ in range(25)] + [("a", None), ("d", D(2030, 5, 1))]
    asked = [(rng.choice("abcd"), day()) for _ in range(60)] + [("a", None), (None, day())]
    got = catalogue.nearest_releases(
        spark.createDataFrame(asked, "cat_no string, requested date"),
        spark.createDataFrame(known, "cat_no string, release_date date"), k)
    want = set()
    for cat, wanted in set(asked):
        days = sorted({d for c, d in known if c == cat and d}, key=lambda d: (abs((d - wanted).days), d)) if wanted else []
        want |= {(cat, wanted, i, d, abs((d - wanted).days)) for i, d in enumerate(days[:k], 1)}
    assert set(map(tuple, got.collect())) == want


def sheet(source, series, value, title=None):
    cells = [(source, 1, "Data1", 1, 1, "s", "Series ID", None, None), (source, 1, "Data1", 1, 2, "s", series, None, None),
             (source, 1, "Data1", 2, 1, "s", "Jan-2031", None, None), (source, 1, "Data1", 2, 2, "n", str(value), value, None),
             (source, 2, "Data2", 1, 1, "s", "Series ID", None, None), (source, 2, "Data2", 1, 2, "s", series + "X", None, None),
             (source, 2, "Data2", 2, 1, "s", "Feb-2031", None, None), (source, 2, "Data2", 2, 2, "n", str(value), value, None)]
    return cells


CELL = ("source_file string, sheet_no int, sheet string, row_no bigint, col_no int, kind string, text string, "
        "num double, date date")


def test_requests_to_observations(spark, index, tmp_path):
    rows = sheet("rain1.xlsx", "R1", 1.0) + sheet("snow.xlsx", "S1", 2.0) + sheet("other.xlsx", "O1", 3.0)
    path = str(tmp_path / "cells")
    spark.createDataFrame(rows, CELL).write.partitionBy("source_file").parquet(path)
    cells = spark.read.parquet(path).select(*[f.split()[0] for f in CELL.split(", ")])
    asked = spark.createDataFrame(
        [(1, "7001.0", None, None, False), (2, "7001.0", "snow", None, False), (3, "7001.0", "sleet", None, False),
         (4, "7001.0", "12", None, False)],
        "request_id int, cat_no string, file string, release string, cube boolean")
    got = requests.read_requests(cells, index, asked)
    found = {(r["request_id"], r["source_file"], r["series_id"], r["cat_no"], r["release_date"]) for r in got.collect()}
    assert found == {
        (1, "rain1.xlsx", "R1", "7001.0", "mar-2031"), (1, "rain1.xlsx", "R1X", "7001.0", "mar-2031"),
        (2, "snow.xlsx", "S1", "7001.0", "mar-2031"), (2, "snow.xlsx", "S1X", "7001.0", "mar-2031"),
        (4, "snow.xlsx", "S1", "7001.0", "mar-2031"), (4, "snow.xlsx", "S1X", "7001.0", "mar-2031")}
    some = requests.read_requests(cells, index, asked, tables=2)
    assert {r["series_id"] for r in some.collect()} == {"R1X", "S1X"}
    with pytest.raises(ValueError, match="1 requests have no file.*no file matched"):
        requests.read_requests(cells, index, asked, strict=True)
    chosen = requests.cells_of_files(cells, requests.chosen_files(index, asked).where("request_id = 2"))
    assert {r["source_file"] for r in chosen.select("source_file").distinct().collect()} == {"snow.xlsx"}


def test_read_family(spark, index):
    rows = [row("6401.0", "Table 1. Prices", "cpi.xlsx", "mar-2031", "1"), row("6202.0", "Gross flows", "flows.xlsx", "mar-2031", None, True)]
    index = spark.createDataFrame(rows, FILE_INDEX)
    cells = spark.createDataFrame(sheet("cpi.xlsx", "P1", 1.0) + sheet("flows.xlsx", "F1", 2.0), CELL)
    assert {r["series_id"] for r in requests.read_family(cells, index, "cpi").collect()} == {"P1", "P1X"}
    # the selector of a time-series family names tables of its workbook
    assert {r["series_id"] for r in requests.read_family(cells, index, "cpi", "2").collect()} == {"P1X"}
    cube = requests.read_family(cells, index, "lfs_grossflows").collect()
    assert cube and {(r["cube"], r["cube_title"], r["release_date"]) for r in cube} == {
        ("flows.xlsx", "Gross flows", "mar-2031")}
    with pytest.raises(ValueError, match="no files for catalogue"):
        requests.read_family(cells, index, "awe")


def test_index_of_parts_is_not_broadcast(spark, tmp_path):
    """Spark sees the size of the texts, not that of their parts: the join with them is told."""
    texts = [("k", f"{i:05d}_statistics of basin {i}.xlsx") for i in range(2000)]
    spark.createDataFrame(texts, "cat string, text string").write.parquet(f"{tmp_path}/texts")
    needles = spark.createDataFrame([("k", "00017_"), ("k", "zz")], "cat string, needle string")
    found = containing(spark.read.parquet(f"{tmp_path}/texts"), needles, ["cat"])
    plan = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert [line for line in plan if "Contains(" in line and "SortMergeJoin" in line]
    assert not [line for line in plan if "Contains(" in line and "Broadcast" in line]
    assert [r["text"] for r in found.collect()] == ["00017_statistics of basin 17.xlsx"]
