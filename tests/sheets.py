"""Fixtures: sheets as rows of values, and as the cells table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from gridtide.schemas import CELLS

def down(labels, dates, values, above=()):
    """A sheet with dates down column 1: rows above, label rows, then a line per date."""
    lines = [list(row) for row in above]
    lines += [[name, *texts] for name, texts in labels]
    return lines + [[date, *row] for date, row in zip(dates, values)]


def across(columns, dates, lines, above=(), below=()):
    """A sheet with dates across a header row: rows above, the header, a line per series."""
    return [*map(list, above), [*columns, *dates], *map(list, lines), *map(list, below)]


# Gauges on an invented river. Columns D and F of the first sheet are gaps, a line between two
# dates is empty, one value can't be read; the third sheet has no dates at all.
GAUGES = {
    "Flow 3": down(
        [
            ("Frequency", ["Quarterly", "Quarterly", None, "Quarterly", None, "Quarterly"]),
            ("Series Start", ["Jun-2041", "Sep-2041", None, "Jun-2041", None, "Dec-2041"]),
            ("Units", ["Cumecs", "Cumecs", None, "Metres", None, "Degrees"]),
            ("Series Number", ["G4400012V", "G4400013W", None, "G4400020X", None, "G4400031Y"]),
            ("Description", ["Flow ; East weir", "Flow ; West weir", None, "Level ; East weir", None, "Warmth"]),
        ],
        ["Q2-2041", "Q3-2041", None, "Q4-2041"],
        [[12.5, None, None, 1.25, None, None], [13, 6, None, "dry", None, None], [],
         [-2, 7.5, None, 1.5, None, 8]],
        above=[["River gauges"], []],
    ),
    "Flow 11a": down([("Series ID", ["G9"]), ("Freq", ["Annual"])], ["2038", "2039", "2040"], [[1], [2], [4]]),
    "Legend": [["Cumecs are cubic metres in a second"], [None, "see also the yearbook"]],
}
PERIODS = {
    "Months": down([("Title", ["wind"]), ("Series ID", ["PM7"])], ["2045/02", "Mar-2045", "2045-04", "May 2045"],
                   [[1], [2], [3], [4]]),
    "Quarters and years": down([("Series ID", ["PQ7", "PY7"])], ["2046-Q1", "Q2 2046", "Sep-2046", "Q4-2046"],
                               [[1, 9], [2, 8], [3, 7], [4, 6]]),
    "Years": down([("Series ID", ["PA7"])], ["2047", "2048"], [[5], [6]]),
}
REPORTS = {
    "Harbours": across(
        ["Series Number", "Title", "Units", "Freq"], ["Jan-2044", "Apr-2044", "Jul-2044", "Oct-2044"],
        [["H1", "Ships in", "Ships", "Quarterly", 40, 41, "nil", 43], ["H2", "Ships out", "Ships", "Quarterly", 39, None, 42, 42],
         ["H3", "Tonnage", "Kilotonnes", "Quarterly", 7.5, 8, 8.5, 9]],
        above=[["Table 31b. Ships by harbour", None, "Catalogue No. 7510.0"], [], [None, "Release: May 2044"], []],
    ),
    "Tides": [
        [None, "Harbour office"], ["Publication Date", None, "June 2045"], ["Cat No", "nr", "7520.0.55.003"], [],
        ["Unit of measure", "Metres", "Metres", "Metres"], ["Series Number", "T5500001K", "draft", "T5500003M"],
        ["Series", "High tide", "Guess", "Low tide"], ["Frequency", "Weekly", "Weekly", "Weekly"],
    ],
    "Table 40": down(
        [("Series ID", ["B6000001Q", "B6000002R"]), ("Frequency", ["Biannual", "Biannual"])],
        ["Jun-2043", "Dec-2043"], [[1, 2], [3, 4]],
        above=[["Buoys out at sea"], ["Released: August 2043"]],
    ),
}
FERRIES = {
    "Ferries": across(
        ["Route", "Day"], ["Jan-2044", "Feb-2044", "Mar-2044", "Apr-2044"],
        [["North", "week", 10, 11, None, 13], ["North", "end", 4, 5, 6, ".."], [], ["South", "week", 20, 21, 22, 23]],
        above=[["Trips by route"]], below=[["© harbour office", None, None, 99], ["East", "week", 1, 1, 1, 1]],
    ),
    "Cover": [["Trips are counted at noon."]],
}
FLEET = {"Fleet": [["Name", "Built"], ["Gull", 2031.0], ["Tern", 2036.0]]}


def cell(value):
    if isinstance(value, bool):
        return "b", str(value).lower(), None, None
    if isinstance(value, (int, float)):
        return "n", str(value), float(value), None
    if isinstance(value, datetime.date):
        return "d", value.isoformat(), None, value
    return "s", value, None, None


def cells_of(spark: SparkSession, **workbooks: dict[str, list[list]]) -> DataFrame:
    rows = []
    for file, sheets in workbooks.items():
        for number, (name, lines) in enumerate(sheets.items(), 1):
            for r, line in enumerate(lines, 1):
                for c, value in enumerate(line, 1):
                    if value not in (None, ""):
                        rows.append((file, number, name, r, c, *cell(value)))
    return spark.createDataFrame(rows, CELLS)
