"""Date expressions that never fail on bad text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import present

# The columns parsed when none are named.
DATE_COLUMNS = ["date", "yelping_since"]


def day(column: str) -> Column:
    """The date part of a date, a timestamp or a text that starts with one; else null."""
    return F.col(column).try_cast("date")


def calendar_year(column: str) -> Column:
    return F.year(day(column))


def calendar_month(column: str) -> Column:
    """``yyyy-MM``."""
    return F.date_format(day(column), "yyyy-MM")


def days_between(start: str, end: str) -> Column:
    return F.datediff(day(end), day(start))


def read_date(column: str) -> Column:
    """Date at the head of a text: ``yyyy-MM-dd`` with anything after it, or ``yyyy-MM``."""
    text = F.trim(F.col(column).cast("string"))
    attempts = [(F.substring(text, 1, 10), "yyyy-MM-dd"), (text, "yyyy-MM-dd"), (text, "yyyy-MM")]
    return F.coalesce(*(F.try_to_date(value, pattern) for value, pattern in attempts))


def with_date_parts(df: DataFrame, columns: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Add ``_parsed``, ``_year``, ``_month`` and ``_day_of_week`` (Sunday = 1) per date column.

    A column holding several timestamps is read by its first one.
    """
    names = present(df, columns)
    takes = {"year": F.year, "month": F.month, "day_of_week": F.dayofweek}
    df = df.withColumns({f"{c}_parsed": read_date(c) for c in names})
    return df.withColumns({f"{c}_{part}": take(f"{c}_parsed") for c in names for part, take in takes.items()})
