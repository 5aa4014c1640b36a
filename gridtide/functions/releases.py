"""Release months in texts and URLs as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridtide.functions.periods import month_number
from gridtide.functions.text import collapse, let, strip
from gridtide.functions.urls import without_query

MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
MONTH_FIRST = rf"\b{MONTH}[a-z]*[- ]+([0-9]{{4}})\b"
YEAR_FIRST = rf"\b([0-9]{{4}})[- ]+{MONTH}[a-z]*\b"


def _first_of(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year, month.cast("string"), F.lit("1")).try_cast("date")


def release_month(text: Column) -> Column:
    """First of the month named anywhere in a text, ``April 2024`` or ``2024 April``."""

    def forward(found: Column) -> Column:
        return _first_of(F.right(found, F.lit(4)), month_number(F.left(found, F.lit(3))))

    def backward(found: Column) -> Column:
        month = F.ltrim(F.substr(found, F.lit(5)), F.lit("- "))
        return _first_of(F.left(found, F.lit(4)), month_number(F.left(month, F.lit(3))))

    def named(plain: Column) -> Column:
        second = let(
            F.regexp_extract(plain, YEAR_FIRST, 0), lambda found: F.when(found != "", backward(found))
        )
        first = let(
            F.regexp_extract(plain, MONTH_FIRST, 0),
            lambda found: F.when(found != "", forward(found)).otherwise(second),
        )
        # without a year there is no month to look for
        return F.when(plain.rlike("[0-9]{4}"), first)

    return let(F.lower(collapse(text)), named)


def release_key(month: Column) -> Column:
    """Text key of a release month, ``apr-2024``."""
    return F.lower(F.date_format(month, "MMM-yyyy"))


def release_text(text: Column) -> Column:
    """Release cell as a key when it names a month, else the trimmed text."""
    return F.coalesce(release_key(release_month(text)), strip(text))


def release_from_url(url: Column) -> Column:
    """``apr-2024`` out of ``.../apr-2024/...``, else null."""
    found = F.regexp_extract(F.lower(url), "/([a-z]{3}-[0-9]{4})/", 1)
    return let(found, lambda key: F.when(key != "", key))


def release_page(url: Column) -> Column:
    """Page a file belongs to: the URL up to its release part, else its directory."""
    clean = without_query(url)
    key = release_from_url(clean)
    upto = F.regexp_extract(clean, "^(.*?/[a-z]{3}-[0-9]{4})/", 1)
    directory = F.regexp_replace(clean, "/[^/]*$", "")
    return F.when(key.isNotNull() & (upto != ""), upto).otherwise(directory)


def is_release_url(url: Column, page_url: Column) -> Column:
    """Whether a link leads to a dated release below a catalogue page."""

    def leads(clean: Column) -> Column:
        below = clean.startswith(F.concat(page_url, F.lit("/")))
        dated = clean.rlike("(?i)/[a-z]{3}-[0-9]{4}/?$")
        named = release_month(release_from_url(clean)).isNotNull()
        return below & (dated | F.coalesce(named, F.lit(False)))

    return let(without_query(url), leads)


