from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from gridtide.functions import numbers, periods, releases, text, urls
from gridtide.operators.tables import table_matches

D = datetime.date


def values(spark, expression, rows, schema):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(expression).collect()]


def texts(spark, function, items):
    return values(spark, function(F.col("t")), [(x,) for x in items], "t string")


def test_periods_of_labels(spark):
    cases = {
        "1998": (D(1998, 1, 1), "annual"), "2031-11": (D(2031, 11, 1), "monthly"),
        "2031/00": None, "2044-Q2": (D(2044, 4, 1), "quarterly"),
        "q1 2019": (D(2019, 1, 1), "quarterly"), "Q2-2051": (D(2051, 4, 1), "quarterly"),
        "Sep-07": (D(2007, 9, 1), "unknown"), "Oct2033": (D(2033, 10, 1), "unknown"),
        "Feb 88": (D(2088, 2, 1), "unknown"), "Row 21": None, "2033-12-30": (D(2033, 12, 30), "unknown"),
        "28/11/2035": (D(2035, 11, 28), "unknown"), "11/28/2035": (D(2035, 11, 28), "unknown"),
        "AUGUST 2040": (D(2040, 8, 1), "unknown"), " July 2016\t": (D(2016, 7, 1), "unknown"),
        "": None, None: None, "30/02/2035": None, "2035Q7": None, "words without end": None,
    }
    got = values(spark, periods.text_period("t"), [(x,) for x in cases], "t string")
    for label, period, want in zip(cases, got, cases.values()):
        if want is None:
            assert period is None or period["date"] is None, label
        else:
            assert tuple(period) == want, label


def test_periods_of_typed_cells(spark):
    rows = [("n", None, 45292.0, None), ("n", None, 42.0, None), ("n", None, 80000.0, None),
            ("n", None, 2958465.0, None), ("n", None, 2958466.0, None),
            ("d", "x", None, D(2024, 5, 2)), ("b", "true", None, None), ("n", "2024", 2024.0, None)]
    got = values(spark, periods.cell_period()["date"], rows,
                 "kind string, text string, num double, date date")
    assert got == [D(2024, 1, 1), None, D(2119, 1, 11), D(9999, 12, 31), None, D(2024, 5, 2), None, None]


def test_period_start(spark):
    rows = [("quarterly", D(2024, 3, 5)), ("annual", D(2024, 10, 1)), ("monthly", D(2024, 3, 5))]
    got = values(spark, periods.period_start(F.col("d"), F.col("f")), rows, "f string, d date")
    assert got == [D(2024, 1, 1), D(2024, 1, 1), D(2024, 3, 5)]


def test_numbers(spark):
    cases = {"1,234.5": 1234.5, "..": None, "NP": None, "n/a": None, "-": None, " -7 ": -7.0,
             "1e3": 1000.0, "12d": None, "NaN": None, "Infinity": None, "0x1p3": None, ".5": 0.5,
             "5.": 5.0, "": None, None: None, "1 2": None}
    assert texts(spark, numbers.text_number, cases) == list(cases.values())


def test_frequencies(spark):
    cases = {"Yearly": "annual", "Fortnightly": "fortnightly", "Daily": "daily", "": "unknown",
             "Mystery cadence": "unknown", "Biannual": "semiannual", " half-yearly": "semiannual",
             None: "unknown", "Quarterly": "quarterly", "weekly": "weekly", "MONTHLY": "monthly"}
    assert texts(spark, text.normalise_frequency, cases) == list(cases.values())


def test_names_and_keys(spark):
    assert texts(spark, text.normalise_name, ["A B", " Mar-2024 ", "%"]) == ["A_B", "Mar2024", "Column"]
    assert texts(spark, text.metadata_key, [" Series  ID:", "Unit of measure"]) == [
        "seriesid", "unitofmeasure"]
    ids = ["A84423043A", " A84423043A ", "A1234", "a84423043a", ""]
    assert texts(spark, text.looks_like_series_id, ids) == [True, True, False, False, False]


def test_table_numbers(spark):
    cases = {"Table 12. Detailed": "12", "Tables 2b to 9b. All": "2b", "tables3": "3",
             "Stable 4": None, "Data": None}
    assert texts(spark, text.table_no, cases) == list(cases.values())


def test_table_requests(spark):
    rows = [("Data1", "1", True), ("Data10", "1", False), ("Table 1a", "1", False),
            ("Data1", "Table 1", True), ("Data1", "data 1", True), ("Table 12. Detailed data", "", False),
            ("Detailed Monthly Data", "monthly", True), ("Table 12. Detailed data", "12", True)]
    got = values(spark, table_matches(F.col("s"), F.col("r")), rows, "s string, r string, want boolean")
    assert got == [row[2] for row in rows]


def test_releases(spark):
    cases = {"Released 2026 September": D(2026, 9, 1), "not a release": None,
             "Released: November 2018": D(2018, 11, 1), "apr-2026": D(2026, 4, 1),
             "sep\xa02019": D(2019, 9, 1)}
    assert texts(spark, releases.release_month, cases) == list(cases.values())
    assert texts(spark, releases.release_text, ["June 2024", " soon "]) == ["jun-2024", "soon"]
    pages = {"https://x.test/path/file.xlsx": "https://x.test/path",
             "https://x.test/path/may-2026/file.xlsx": "https://x.test/path/may-2026",
             "https://x.test/p/may-2026/a/file.xlsx?x=/": "https://x.test/p/may-2026"}
    assert texts(spark, releases.release_page, pages) == list(pages.values())
    got = values(spark, releases.is_release_url(F.col("u"), F.lit("https://x.test/p")),
                 [("https://x.test/p/may-2026",), ("https://x.test/p/release/may-2026/details",),
                  ("https://y.test/may-2026",), ("https://x.test/p/about",)], "u string")
    assert got == [True, True, False, False]


def test_urls(spark):
    absolute = {" HTTP://x.test/file.xlsx ": "HTTP://x.test/file.xlsx",
                "//x.test/file.xlsx": "https://x.test/file.xlsx", "/a": "https://b.test/base//a",
                "relative/file.xlsx": "https://b.test/base/relative/file.xlsx"}
    got = texts(spark, lambda c: urls.absolute_url(c, "https://b.test/base/"), absolute)
    assert got == list(absolute.values())
    assert texts(spark, urls.safe_filename, [" ?? ", "a b/c__d."]) == ["download", "a_b_c_d."]
    assert texts(spark, urls.url_filename, ["https://x.test/", "https://x.test/a.xlsx?b"]) == [
        "download", "a.xlsx"]
    rows = [("https://x.test/download", "Detailed data cube"), ("https://x.test/download", "Plain"),
            ("https://x.test/a.XLSX", "Plain")]
    got = values(spark, urls.file_type(F.col("u"), F.col("l")), rows, "u string, l string")
    assert got == ["cube", "unknown", "xlsx"]
    rows = [("6202.0", "https://x.test/62020001.xlsx"), ("6401.0", "https://x.test/640101b.xlsx"),
            ("6202.0", "https://x.test/other.xlsx")]
    got = values(spark, urls.table_no_from_filename(F.col("c"), F.col("u")), rows, "c string, u string")
    assert got == ["1", "1b", None]


def test_titles(spark):
    assert texts(spark, urls.is_generic_label, ["Download xlsx [750 KB]", "", "Table 1", "CSV"]) == [
        True, True, False, True]
    got = texts(spark, lambda c: urls.context_title(c, F.lit("Download xlsx [1 KB]")),
                ["Table 3. Jobs - Download xlsx [1 KB]", "Predownload notes"])
    assert got == ["Table 3. Jobs", "Pre notes"]
    scores = texts(spark, urls.title_score, ["Table 1. Good", "Download", ""])
    assert scores[0] > scores[1] and scores[2] == 0
    scores = texts(spark, urls.context_score, ["Table 1. Short", "Download"])
    assert scores[0] > scores[1]


@pytest.mark.parametrize("layout", ["sideways"])
def test_unknown_layout_is_an_error(spark, layout):
    from gridtide.operators.timeseries import tidy
    from sheets import GAUGES, cells_of

    with pytest.raises(ValueError):
        tidy(cells_of(spark, a=GAUGES), layout=layout)
