"""Choosing columns by name and type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def of_type(df: DataFrame, *kinds: type, without: Iterable[str] = ()) -> list[str]:
    """Names of the columns whose type is one of ``kinds``, in schema order."""
    skip = set(without)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def numeric_columns(df: DataFrame, without: Iterable[str] = (), not_ending: Iterable[str] = ()) -> list[str]:
    """Every numeric column, except the named ones and those with one of the suffixes."""
    suffixes = tuple(not_ending)
    return [c for c in of_type(df, T.NumericType, without=without) if not (suffixes and c.endswith(suffixes))]


def string_columns(df: DataFrame, without: Iterable[str] = ()) -> list[str]:
    return of_type(df, T.StringType, without=without)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that the frame really has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def comparable_sql(df: DataFrame, name: str) -> str:
    """``name`` as something Spark can order, as SQL text: a map becomes its sorted entries."""
    is_map = isinstance(df.schema[name].dataType, T.MapType)
    return f"array_sort(map_entries({quoted(name)}))" if is_map else quoted(name)


def comparable(df: DataFrame, name: str) -> Column:
    return F.expr(comparable_sql(df, name))


def missing_sql(df: DataFrame, name: str) -> str:
    """True for null, and for NaN in a floating-point column, as SQL text."""
    fractional = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return f"({quoted(name)} IS NULL OR isnan({quoted(name)}))" if fractional else f"({quoted(name)} IS NULL)"


def missing(df: DataFrame, name: str) -> Column:
    return F.expr(missing_sql(df, name))
