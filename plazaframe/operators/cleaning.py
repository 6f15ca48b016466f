"""Missing values and duplicate rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable, missing_sql, numeric_columns, present, quoted, string_columns
from plazaframe.functions.measures import rows
from plazaframe.operators.durable import settled
from plazaframe.operators.quantiles import exact_quantiles
from plazaframe.operators.ranking import one_per_key


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns all have a value."""
    have = present(df, keys)
    return df.dropna(subset=have) if have else df


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any null (NaN counts as one)."""
    return df.dropna(how="any")


def accuracy(relative_error: float) -> int:
    """The accuracy of ``percentile_approx`` that keeps ranks within an error."""
    return max(1, round(1 / relative_error))


def fill_values(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "median",
    relative_error: float | None = None,
    *,
    keys: Sequence[str] = (),
) -> tuple[dict[str, float], int]:
    """What to put for a missing number, per column, and how many rows the table has.

    Only rows that have all ``keys`` are measured, though all are counted.  The median is exact;
    with ``relative_error`` it comes, in one pass, from a sketch of bounded size whose rank is off by
    at most that share of the rows.  A column without any value is filled with 0.
    """
    if method not in ("median", "mean"):
        raise ValueError(f"unknown way to fill numbers: {method!r}")
    if method == "median" and relative_error is None:
        middle = exact_quantiles(without_null_keys(df, keys), columns, [0.5])
        return {c: 0.0 if v[0] is None else v[0] for c, v in middle.items()}, df.count()
    keyed = [f"{quoted(k)} IS NOT NULL" for k in present(df, keys)]
    sought = ["count(1) AS n"]
    for i, c in enumerate(columns):
        known = f"CASE WHEN {' AND '.join([*keyed, 'NOT ' + missing_sql(df, c)])} THEN {quoted(c)} END"
        measure = f"percentile_approx({known}, 0.5, {accuracy(relative_error)})" if method == "median" else f"avg({known})"
        sought.append(f"CAST({measure} AS DOUBLE) AS v{i}")
    number, *values = df.selectExpr(*sought).first()
    return {c: 0.0 if v is None else v for c, v in zip(columns, values)}, number


def fill_missing(
    df: DataFrame,
    numbers: dict[str, float],
    text: str = "Unknown",
    *,
    leave: Iterable[str] = (),
) -> DataFrame:
    """Put the given numbers and one text in the place of nulls; other types stay as they are.

    A fraction put into a whole-number column loses its fraction.
    """
    fills = {**numbers, **{c: text for c in string_columns(df, without=leave)}}
    return df.fillna(fills) if fills else df


def impute(
    df: DataFrame,
    keys: Sequence[str],
    method: str = "median",
    text: str = "Unknown",
    *,
    relative_error: float | None = None,
    leave: Iterable[str] = (),
) -> DataFrame:
    """Drop rows without a key, then fill every other column but those to ``leave``."""
    skip = [*keys, *leave]
    numbers, _ = fill_values(df, numeric_columns(df, without=skip), method, relative_error, keys=keys)
    return fill_missing(without_null_keys(df, keys), numbers, text, leave=skip)


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, by default the smallest by all other columns.

    Unlike ``dropDuplicates`` the survivor does not depend on the order of arrival.  A frame
    that lacks one of the keys is left alone.

    A pass over the key columns tells whether any key occurs more than once. If none does, nothing
    else is done; otherwise each task drops all but one row per key before the shuffle.
    """
    if not keys or present(df, keys) != list(keys):
        return df
    rest = [comparable(df, c).asc() for c in df.columns if c not in keys]
    first = [*(order or []), *(rest or [F.col(keys[0]).asc()])]
    df = settled(df)
    per_key = df.groupBy(*keys).agg(rows().alias("_n"))
    number = per_key.agg(F.count_if(F.col("_n") > 1)).first()[0]
    if number == 0:
        return df
    return one_per_key(df, keys, first)
