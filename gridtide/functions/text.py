"""Text cleaning and naming rules as pure ``Column -> Column`` functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

TABLE_NO = r"(?i)\btables?\s*([0-9]+[a-z]?)\b"
# Characters stripped from both ends of a cell.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0"
# One of these is in every text with a run of blanks that is not a single plain one.
UNEVEN = ["  ", "\t", "\n", "\x0b", "\f", "\r"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def holds_any(text: Column, words: list[str]) -> Column:
    """Whether one of the words is in a text; far cheaper than a pattern."""
    return reduce(Column.__or__, [text.contains(word) for word in words])


def squeeze(text: Column) -> Column:
    """Runs of blanks become one plain blank."""
    return let(
        text,
        lambda plain: F.when(holds_any(plain, UNEVEN), F.regexp_replace(plain, r"\s+", " ")).otherwise(plain),
    )


def strip(text: Column) -> Column:
    """Trim every kind of blank, the non-breaking one included."""
    return F.btrim(text, F.lit(BLANKS))


def clean_text(text: Column) -> Column:
    """Trimmed text; a blank cell is the same thing as a missing one."""
    trimmed = strip(text)
    return F.when(trimmed != "", trimmed)


def metadata_key(text: Column) -> Column:
    """Comparison key of a label cell: lower case letters and digits only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def filter_key(text: Column) -> Column:
    """Comparison key of a dimension name, label or filter name."""
    return metadata_key(text)


def normalise_name(text: Column) -> Column:
    """Column name made from a header cell."""
    joined = F.regexp_replace(strip(text), r"\s+", "_")
    kept = F.regexp_replace(joined, "[^A-Za-z0-9_]", "")
    return F.when(kept == "", "Column").otherwise(kept)


def collapse(text: Column) -> Column:
    """Non-breaking blanks become blanks, runs of blanks become one, ends trimmed."""
    return F.trim(squeeze(F.replace(text, F.lit("\xa0"), F.lit(" "))))


def looks_like_series_id(text: Column) -> Column:
    """``A84423043A``-like identifiers: a capital, then five or more capitals or digits."""
    return strip(text).rlike("^[A-Z][A-Z0-9]{5,}$")


def normalise_frequency(text: Column) -> Column:
    """Canonical frequency word of a label such as ``Quarterly`` or ``Half-yearly``."""
    word = F.lower(strip(text))
    # Accepted prefixes and the frequency each one stands for.
    prefixes = [
        ("month", "monthly"),
        ("quarter", "quarterly"),
        ("annual", "annual"),
        ("year", "annual"),
        ("week", "weekly"),
        ("fortnight", "fortnightly"),
        ("biannual", "semiannual"),
        ("semiannual", "semiannual"),
        ("half-year", "semiannual"),
        ("day", "daily"),
        ("dail", "daily"),
    ]
    out = F
    for prefix, name in prefixes:
        out = out.when(word.startswith(prefix), name)
    return out.otherwise("unknown")


def table_no(text: Column) -> Column:
    """``2b`` out of ``Tables 2b to 9b``; null when no table number is present."""
    return let(F.regexp_extract(text, TABLE_NO, 1), lambda found: F.when(found != "", found))
