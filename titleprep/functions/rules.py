"""Cleaning rules as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = r"\N"


def drop_sentinel(text: Column) -> Column:
    """Null in place of the sentinel; anything else is kept as it is."""
    return F.nullif(text.cast("string"), F.lit(SENTINEL))


def to_int(col: Column) -> Column:
    """Whole number; a decimal part is cut off, other text gives null."""
    text = col.cast("string")
    decimal = F.when(text.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), text.try_cast("double").try_cast("int"))
    return F.coalesce(text.try_cast("int"), decimal)


def to_float(col: Column) -> Column:
    """32-bit number, null where the text is no number; NaN is none."""
    return F.nullif(col.try_cast("float"), F.lit(math.nan).cast("float"))


def to_double(col: Column) -> Column:
    return F.nullif(col.try_cast("double"), F.lit(math.nan))


def to_flag(col: Column) -> Column:
    """A boolean or a number, or the text of one, as a whole number."""
    text = col.cast("string")
    return F.coalesce(text.try_cast("boolean").cast("int"), to_int(text))


def within(col: Column, low, high) -> Column:
    """Null outside the closed range."""
    return F.when(col.between(low, high), col)


def above_up_to(col: Column, low, high) -> Column:
    """Null outside the range that leaves ``low`` out and takes ``high`` in."""
    return F.when((col > low) & (col <= high), col)


def at_least(col: Column, low) -> Column:
    return F.when(col >= low, col)


def same(a: Column, b: Column) -> Column:
    """1 if both are equal, 0 if not or if one is null."""
    return F.when(a == b, 1).otherwise(0)


def present(col: Column) -> Column:
    return col.isNotNull().cast("int")


def count_present(*cols: Column) -> Column:
    total = F.lit(0)
    for col in cols:
        total = total + present(col)
    return total


def year_of_first(*dates: Column) -> Column:
    """Year of the earliest date; nulls and texts that are no date are skipped."""
    parsed = [F.try_to_date(d.cast("string")) for d in dates]
    first = F.least(*parsed) if len(parsed) > 1 else parsed[0]
    return F.year(first)


def log_count(col: Column) -> Column:
    """``log(1 + x)`` as a 32-bit number."""
    return F.log1p(col).cast("float")


def split_list(text: Column) -> Column:
    """Elements of a comma list, untrimmed; null for null."""
    return F.split(text, ",", -1)
