"""Period labels, spreadsheet serials and frequencies as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridtide.functions.text import BLANKS

# Month names in calendar order.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Numbers above 10,000 are spreadsheet day serials, which end with the year 9999.
FIRST_SERIAL, LAST_SERIAL = 10_001, 2_958_465
SERIAL_EPOCH = "1899-12-30"


def _lookup(pairs: list[tuple[str, int]]) -> Column:
    return F.create_map(*[F.lit(item) for pair in pairs for item in pair])


def month_number(name: Column) -> Column:
    """1..12 for a three-letter month name in any case, else null."""
    table = _lookup([(month[:3], i) for i, month in enumerate(MONTHS, 1)])
    return F.try_element_at(table, F.lower(name))


def serial_date(num: Column) -> Column:
    """Day serial of a spreadsheet as a date; null for what is no serial."""
    serial = F.bround(num).cast("double")
    inside = serial.between(FIRST_SERIAL, LAST_SERIAL)
    return F.when(inside, F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial.cast("int")))


def _sql_text(value: str) -> str:
    escaped = "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in value)
    return "'" + escaped.replace("'", "\\'") + "'"


def _period_sql(text: str) -> str:
    """SQL of :func:`text_period`; one parsed expression is far cheaper to build than a
    tree of Column calls, and the optimizer sees the same thing."""
    t = f"btrim({text}, {_sql_text(BLANKS)})"
    year = "^([0-9]{4})$"
    year_month = "^([0-9]{4})[-/]([0-9]{1,2})$"
    year_quarter = "(?i)^([0-9]{4})[- ]?Q([1-4])$"
    quarter_year = "(?i)^Q([1-4])[- ]?([0-9]{4})$"
    month_year = "^([A-Za-z]{3})[- ]?([0-9]{2}|[0-9]{4})$"
    iso_day = "^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$"
    slash_day = "^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
    full_month = "^([A-Za-z]{4,9}) ([0-9]{4})$"

    def part(pattern: str, group: int) -> str:
        return f"regexp_extract({t}, '{pattern}', {group})"

    def day(year: str, month: str, day: str = "'1'") -> str:
        return f"try_cast(concat_ws('-', {year}, {month}, {day}) AS DATE)"

    def quarter_month(digit: str) -> str:
        return f"element_at(array('1', '4', '7', '10'), try_cast({digit} AS INT))"

    def month(name: str, names: list[str]) -> str:
        pairs = ", ".join(f"'{m}', '{i}'" for i, m in enumerate(names, 1))
        # An unknown name leaves no month, hence no date.
        return f"coalesce(try_element_at(map({pairs}), lower({name})), 'none')"

    short = [m[:3] for m in MONTHS]
    century = f"right(concat('20', {part(month_year, 2)}), 4)"
    branches = [
        (year, day(t, "'1'"), "annual"),
        (year_month, day(part(year_month, 1), part(year_month, 2)), "monthly"),
        (
            year_quarter,
            day(part(year_quarter, 1), quarter_month(part(year_quarter, 2))),
            "quarterly",
        ),
        (
            quarter_year,
            day(part(quarter_year, 2), quarter_month(part(quarter_year, 1))),
            "quarterly",
        ),
        (month_year, day(century, month(part(month_year, 1), short)), "unknown"),
        (iso_day, f"try_cast({t} AS DATE)", "unknown"),
        (
            slash_day,
            "coalesce("
            + day(part(slash_day, 3), part(slash_day, 2), part(slash_day, 1))
            + ", "
            + day(part(slash_day, 3), part(slash_day, 1), part(slash_day, 2))
            + ")",
            "unknown",
        ),
        (full_month, day(part(full_month, 2), month(part(full_month, 1), MONTHS)), "unknown"),
    ]
    cases = " ".join(
        f"WHEN {t} RLIKE '{pattern}' THEN named_struct('date', {date}, 'frequency', '{name}')"
        for pattern, date, name in branches
    )
    # No accepted label is shorter than "2024" or longer than "September 2024":
    # the length test keeps the patterns away from ordinary data cells.
    return f"CASE WHEN length({t}) NOT BETWEEN 4 AND 14 THEN NULL {cases} END"


def text_period(text: str) -> Column:
    """``struct<date, frequency>`` of a text label (column name or SQL expression).

    The first pattern that fits decides, also when its parts name no real date; the
    ``date`` field is null for everything that is not a period.
    """
    return F.expr(_period_sql(text))


def cell_period() -> Column:
    """``struct<date, frequency>`` of a cell from its ``kind``, ``text``, ``num``, ``date``."""
    serial = (
        f"CASE WHEN bround(num) BETWEEN {FIRST_SERIAL} AND {LAST_SERIAL} "
        f"THEN date_add(DATE'{SERIAL_EPOCH}', CAST(bround(num) AS INT)) END"
    )
    return F.expr(
        f"CASE WHEN kind = 's' THEN {_period_sql('text')} "
        f"WHEN kind = 'n' THEN named_struct('date', {serial}, 'frequency', 'unknown') "
        "WHEN kind = 'd' THEN named_struct('date', date, 'frequency', 'unknown') END"
    )


def period_start(date: Column, frequency: Column) -> Column:
    """First day of the quarter or year for those two frequencies, else the date itself."""
    return (
        F.when(frequency == "quarterly", F.trunc(date, "quarter"))
        .when(frequency == "annual", F.trunc(date, "year"))
        .otherwise(date)
    )


def month_index(date: Column) -> Column:
    """Months since year 0, so that month deltas are plain differences."""
    return F.year(date) * 12 + F.month(date)
