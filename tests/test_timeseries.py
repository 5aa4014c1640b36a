from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from gridtide.operators import sheets as sheet_ops
from gridtide.operators.context import sheet_context
from gridtide.operators.series import latest_date, lookup_series, separate_series
from gridtide.operators.tables import cells_of_tables, require_tables, select_sheets
from gridtide.operators.timeseries import series_metadata, tidy
from gridtide.schemas import CELLS, OBS, SERIES_META
from sheets import GAUGES, PERIODS, REPORTS, cells_of

D = datetime.date
FOOTED = {
    "Across": [
        ["Series ID", "Series", "Sep-2035", "Dec-2035", "Mar-2036"],
        ["R4040404X", "Valves", 1, 2, ".."],
        ["bare line", "17", 3, 4, 5],
        ["Source: the board", None, None, None, 9],
    ]
}


@pytest.fixture(scope="module")
def observations(spark):
    cells = cells_of(spark, gauges=GAUGES, periods=PERIODS, reports=REPORTS, footed=FOOTED)
    rows = tidy(cells, ordinals=True).orderBy("source_file", "sheet_no", "col_no", "row_no")
    return rows.toPandas()


def of(frame, **conditions):
    for name, value in conditions.items():
        frame = frame[frame[name] == value]
    return frame


def test_columns_in_order(spark):
    assert tidy(cells_of(spark, a=PERIODS), cat_no="1").columns == ["source_file", *OBS]


def test_dates_down_with_gaps(observations):
    found = of(observations, source_file="gauges")
    assert found.groupby("sheet").size().to_dict() == {"Flow 3": 12, "Flow 11a": 3}
    dates = [D(2041, 4, 1), D(2041, 7, 1), D(2041, 10, 1)]
    for series in ("G4400012V", "G4400013W", "G4400020X", "G4400031Y"):
        assert list(of(found, series_id=series)["date"]) == dates  # a dense grid without the gaps
    assert list(of(found, series_id="G4400012V")["value"]) == [12.5, 13, -2]
    assert list(of(found, series_id="G4400020X")["value"].isna()) == [False, True, False]
    assert list(of(found, series_id="G4400031Y")["value"].isna()) == [True, True, False]
    west = of(found, series_id="G4400013W").iloc[0]
    assert (west["unit"], west["series"], west["series_start"]) == ("Cumecs", "Flow ; West weir", "Sep-2041")
    assert set(of(found, sheet="Flow 3")["frequency"]) == {"quarterly"}
    assert set(of(found, sheet="Flow 11a")["frequency"]) == {"annual"}


def test_periods(observations):
    found = of(observations, source_file="periods")
    dates = {k: list(g["date"]) for k, g in found.groupby("series_id")}
    quarters = [D(2046, 1, 1), D(2046, 4, 1), D(2046, 7, 1), D(2046, 10, 1)]
    assert dates == {
        "PM7": [D(2045, m, 1) for m in (2, 3, 4, 5)], "PQ7": quarters, "PY7": quarters,
        "PA7": [D(2047, 1, 1), D(2048, 1, 1)],
    }
    assert dict(zip(found["series_id"], found["frequency"])) == {
        "PM7": "monthly", "PQ7": "quarterly", "PY7": "quarterly", "PA7": "annual"}


def test_time_across(observations):
    found = of(observations, source_file="reports", sheet="Harbours")
    assert found.groupby("series_id").size().to_dict() == {"H1": 4, "H2": 4, "H3": 4}
    assert list(of(found, series_id="H1")["value"].isna()) == [False, False, True, False]
    assert list(of(found, series_id="H2")["value"].isna()) == [False, True, False, False]
    third = of(found, series_id="H3")
    assert list(third["value"]) == [7.5, 8, 8.5, 9] and set(third["unit"]) == {"Kilotonnes"}
    assert list(third["date"]) == [D(2044, m, 1) for m in (1, 4, 7, 10)]
    assert set(found["cat_no"]) == {"7510.0"} and set(found["release_date"]) == {"may-2044"}
    assert set(found["table_no"]) == {"31b"} and set(of(found, series_id="H1")["series"]) == {"Ships in"}
    footed = of(observations, source_file="footed")
    # Without cutting, the source line is a series like any other.
    assert set(footed["series_id"]) == {"R4040404X", "bare line", "Source: the board"}
    assert set(footed["frequency"]) == {"quarterly"}
    assert list(of(footed, series_id="R4040404X")["value"].isna()) == [False, False, True]


def test_cut_footers(spark):
    cells = cells_of(spark, footed=FOOTED)
    found = tidy(cells, cut_footers=True).toPandas()
    assert set(found["series_id"]) == {"R4040404X", "bare line"} and len(found) == 6


def test_without_metadata(spark):
    found = tidy(cells_of(spark, s={"Flow 3": GAUGES["Flow 3"]}), metadata=False).toPandas()
    assert found["unit"].isna().all() and set(found["frequency"]) == {"quarterly"}
    assert dict(zip(found["series_id"], found["series"])) == {
        "G4400012V": "Column 2", "G4400013W": "Column 3", "G4400020X": "Column 5", "G4400031Y": "Column 7"}


def test_header_rules(spark):
    rows = [
        ["Unit", "first"], ["Units", "second", "only"], ["R1010101X", None, "R2020202"],
        ["Unit", "", "late"], ["2024", 1, 2], ["2025", None, 4], [None, None, None, "note"],
    ]
    found = tidy(cells_of(spark, a={"S": rows})).toPandas()
    ids = of(found, date=D(2024, 1, 1)).set_index("series_id")
    # The lowest "Unit" row counts; where it is blank the next candidate label does.
    assert ids["unit"].to_dict() == {"Column 2": "second", "R2020202": "late", "Column 4": None}
    # Columns filled by a footer only are series too, and missing cells stay as rows.
    assert len(found) == 6 and of(found, series_id="Column 4")["value"].isna().all()


def test_metadata(spark):
    found = series_metadata(cells_of(spark, reports=REPORTS, gauges={"Flow 3": GAUGES["Flow 3"]}))
    assert found.columns == ["source_file", *SERIES_META]
    frame = found.toPandas()
    assert len(of(frame, source_file="gauges")) == 4
    reports = of(frame, source_file="reports")
    assert reports.groupby("sheet")["series_id"].apply(sorted).to_dict() == {
        "Harbours": ["H1", "H2", "H3"], "Tides": ["T5500001K", "T5500003M"],
        "Table 40": ["B6000001Q", "B6000002R"]}  # a column of labels needs a series number
    one = reports.groupby("sheet").first()
    assert one["release_date"].to_dict() == {
        "Harbours": "may-2044", "Tides": "jun-2045", "Table 40": "aug-2043"}
    assert one["cat_no"].to_dict() == {"Harbours": "7510.0", "Tides": "7520.0.55.003", "Table 40": None}
    assert one["frequency"].to_dict() == {
        "Harbours": "quarterly", "Tides": "weekly", "Table 40": "semiannual"}
    assert one["table_title"]["Harbours"] == "Table 31b. Ships by harbour" and one["table_no"]["Table 40"] == "40"
    assert one["unit"]["Tides"] == "Metres" and one["series"]["Tides"] in ("High tide", "Low tide")


def test_context(spark):
    sheets = {
        "Spills": [["Catalogue Number", "7800.0"], ["Released: August 2034"],
                   ["Table 14. Spills by weir"], ["2034", 1]],
        "Table 21": [["Release Date", ""], ["Released: May 2035"], ["2035", "Table 3. below the dates"]],
        "Plain": [["Release Date", "", "late 2036"], ["see Catalogue no. 7811.5"]],
    }
    found = sheet_context(cells_of(spark, a=sheets)).toPandas().set_index("sheet")
    assert list(found.loc["Spills", ["cat_no", "release_date", "table_no"]]) == [
        "7800.0", "aug-2034", "14"]
    assert found["release_date"]["Table 21"] == "may-2035" and found["table_no"]["Table 21"] == "21"
    assert found["table_title"]["Table 21"] == "Table 21"
    assert found["cat_no"]["Plain"] == "7811.5" and found["release_date"]["Plain"] == "late 2036"
    given = sheet_context(cells_of(spark, a=sheets), cat_no="1.0", release_date="x").toPandas()
    assert set(given["cat_no"]) == {"1.0"} and set(given["release_date"]) == {"x"}


def test_best_lines_and_frequency(spark):
    rows = {"A": [["gate", "when", "level"], ["1", "Aug-2037", 1], ["2", "Sep-2037", 2], ["3", "Oct-2037", "2038"]]}
    cells = cells_of(spark, a=rows)
    best = sheet_ops.best_date_column(cells).first()
    assert (best["col_no"], best["n_dates"]) == (2, 3)
    assert sheet_ops.best_date_row(cells).first()["row_no"] == 4
    cases = {
        "single": ([D(2030, 5, 1)], "unknown"),
        "months": ([D(2030, 11, 1), D(2030, 12, 1), D(2031, 1, 1)], "monthly"),
        "quarters": ([D(2030, 8, 1), D(2030, 11, 1), D(2031, 2, 1)], "quarterly"),
        "years": ([D(2030, 7, 1), D(2031, 7, 1), D(2032, 7, 1)], "annual"),
        "seven months": ([D(2030, 1, 1), D(2030, 8, 1)], "unknown"),
        "lower of two": ([D(2030, 4, 1), D(2030, 5, 1), D(2030, 8, 1)], "monthly"),
        "days": ([D(2030, 1, 1), D(2030, 1, 9), D(2030, 1, 9), D(2030, 2, 1)], "unknown"),
    }
    dates = [(k, d, "unknown") for k, (ds, _) in cases.items() for d in ds]
    dates += [("mixed", D(2031, 3, 1), "annual"), ("mixed", D(2031, 4, 1), "monthly"),
              ("implied", D(2031, 3, 1), "annual"), ("implied", D(2031, 4, 1), "unknown")]
    df = spark.createDataFrame(dates, "k string, period_date date, period_frequency string")
    got = {r["k"]: r["inferred"] for r in sheet_ops.infer_frequency(df, ["k"]).collect()}
    assert got == {**{k: f for k, (_, f) in cases.items()}, "mixed": "monthly", "implied": "annual"}


def test_large_sheet_spreads_over_tiles(spark):
    """A sheet of many tiles gives the full grid, also across tile borders."""
    n_rows, cols = 40_000, [2, 1024, 1025, 2050]
    rows = spark.range(n_rows).select(
        F.lit("big").alias("source_file"), F.lit(1).alias("sheet_no"), F.lit("S").alias("sheet"),
        (F.col("id") + 2).alias("row_no"),
    )
    date = F.date_format(F.date_add(F.lit("1930-01-01").cast("date"), F.col("row_no").cast("int")), "yyyy-MM-dd")
    empty = [F.lit(None).cast("double").alias("num"), F.lit(None).cast("date").alias("date")]
    labels = rows.select("*", F.lit(1).alias("col_no"), F.lit("s").alias("kind"), date.alias("text"), *empty)
    body = rows.where(F.col("row_no") % 3 != 0).select(
        "*", F.explode(F.array(*[F.lit(c) for c in cols])).alias("col_no"), F.lit("n").alias("kind"),
        F.col("row_no").cast("string").alias("text"), F.col("row_no").cast("double").alias("num"),
        F.lit(None).cast("date").alias("date"),
    )
    cells = labels.unionByName(body).select(*CELLS.names)
    found = tidy(cells, layout="down")
    total = found.agg(F.count("*"), F.count("value"), F.sum("value"), F.countDistinct("series_id")).first()
    filled = [r for r in range(2, n_rows + 2) if r % 3]
    assert tuple(total) == (n_rows * 4, len(filled) * 4, float(sum(filled) * 4), 4)


def test_table_selection(spark):
    cells = cells_of(spark, a=GAUGES)
    for request in (3, "3", "Table 3", ["Flow 3"]):
        assert {r["sheet"] for r in cells_of_tables(cells, request).select("sheet").distinct().collect()} == {"Flow 3"}
    assert select_sheets(cells).count() == cells.count()
    assert select_sheets(cells, ["Flow 3", "Flow 11a"]).select("sheet").distinct().count() == 2
    with pytest.raises(ValueError, match="Flow 11a"):
        require_tables(cells, 999)


def test_series_workflow(spark, observations):
    frame = observations[OBS].astype({"value": "float64"})
    df = spark.createDataFrame(
        [tuple(None if v != v else v for v in row) for row in
         frame[["series_id", "date", "value"]].itertuples(index=False)],
        "series_id string, date date, value double")
    assert lookup_series(df, [" g4400012v"]).count() == 3
    wanted = spark.createDataFrame([("G4400012V",), ("PA7",), ("missing",)], "series_id string")
    assert lookup_series(df, wanted).count() == 5
    assert lookup_series(df, "missing").count() == 0
    newest = lookup_series(df, "G4400012V")
    assert latest_date(newest).first()["latest_date"] == D(2041, 10, 1)
    assert latest_date(df.where("false")).first()["latest_date"] is None
    with pytest.raises(ValueError):
        latest_date(df, "when")


def test_separate_series(spark):
    labels = ["Rain, North, Total", "Pump hours, South", "Leaks", None, "a;b|c,d", "x | y"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, series string")
    named = separate_series(df, names=["what", "where", "rest"])
    rows = {r["i"]: r for r in named.collect()}
    assert named.columns == ["i", "series", "what", "where", "rest"]
    assert rows[0]["what"] == "Rain" and rows[0]["rest"] == "Total"
    assert rows[3]["what"] is None and rows[4]["where"] == "b|c,d" and rows[5]["where"] == "y"
    plain = {r["i"]: r for r in separate_series(df, remove_totals=True).collect()}
    assert plain[0]["series_part_2"] == "North" and "series_part_3" not in plain[0]
    assert plain[1]["series_part_2"] == "South"
    kept = separate_series(df.where("i < 4"), names=["what", "where"], remove_totals=True, drop_missing=True)
    assert sorted((r["what"], r["where"]) for r in kept.collect()) == [("Pump hours", "South"), ("Rain", "North")]
    for bad in (["alone"], "what"):
        with pytest.raises(ValueError):
            separate_series(df, names=bad)
    with pytest.raises(ValueError):
        separate_series(df, column="nothing")


def test_facts_below_a_long_preface(spark):
    preface = [[f"line {i}"] for i in range(45)]
    rows = [*preface, ["Catalogue number", None, 7301.0], ["Release date", "March 2031"],
            ["Table 7. Wells by depth"], ["Series ID", "W1"], ["Jan-2031", 1], ["Released: May 1999"],
            ["Table 8. A far longer title below the first date"]]
    late = [["Series ID", "V1"], ["Jan-2031", 1]] + [["x", i] for i in range(40)] + [["Catalogue No: 9999.0"]]
    early = [["Table 1. Near"], ["Series ID", "U1"], ["Jan-2031", 1], ["Released: June 2031"]]
    cells = cells_of(spark, f={"A": rows, "B": late, "C": early})
    found = {r["sheet"]: (r["cat_no"], r["release_date"], r["table_title"]) for r in sheet_context(cells).collect()}
    assert found == {
        "A": ("7301.0", "mar-2031", "Table 7. Wells by depth"),  # above the first date
        "B": (None, None, "B"),  # far below it
        "C": (None, "jun-2031", "Table 1. Near"),  # below it, but among the first rows
    }
    plan = sheet_context(cells)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_facts_of_far_rows_are_repeated_a_bounded_number_of_times(spark):
    """Row numbers may be sparse: what a sheet says is repeated for tiles, not for all its blocks,
    and Spark sees that it is."""
    from gridtide.operators import sheets

    far = 9_000_000
    facts = spark.createDataFrame(
        [("f", 1, far, "far"), ("f", 2, 3, "near"), ("f", 3, 0, "above")],
        "source_file string, sheet_no int, max_row long, fact string")
    rows = spark.createDataFrame(
        [("f", 1, r) for r in (1, 16_384, 16_385, 5_000_000, far)]
        + [("f", 2, r) for r in (1, 3)] + [("f", 3, 0)],
        "source_file string, sheet_no int, row_no long")
    joined = sheets.join_sheets(rows, facts)
    assert joined.count() == rows.count() == joined.select("source_file", "sheet_no", "row_no").distinct().count()
    assert {(r["sheet_no"], r["fact"]) for r in joined.collect()} == {(1, "far"), (2, "near"), (3, "above")}
    right = sheets.tiled(facts, "row_block", "max_row", sheets.ROW_BITS)
    assert right.count() == sheets.TILES + 2
    size = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size(right) >= sheets.TILES * size(facts)
