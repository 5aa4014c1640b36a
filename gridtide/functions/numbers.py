"""Numeric cell values as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridtide.functions.text import strip

# Texts that stand for "no value" in published tables.
NO_VALUE = ["na", "n/a", "np", "..", "-"]
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def text_number(text: Column) -> Column:
    """Double of a printed number such as ``1,234.5``, else null."""
    trimmed = strip(text)
    digits = F.replace(trimmed, F.lit(","), F.lit(""))
    # The guard keeps out what a plain cast would also accept ("1d", "NaN").
    usable = ~F.lower(trimmed).isin(NO_VALUE) & digits.rlike(NUMBER)
    return F.when(usable, digits.try_cast("double"))


def cell_number(kind: Column, text: Column, num: Column) -> Column:
    """Double of a typed cell; booleans and dates carry no number."""
    return F.when(kind == "n", num).when(kind == "s", text_number(text))
