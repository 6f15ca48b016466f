"""Arithmetic expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_total(names: Sequence[str]) -> Column:
    """Sum across the columns of one row; null if any of them is null."""
    first, *rest = names
    return sum((F.col(n) for n in rest), start=F.col(first))


def mean_from(total: Column, n: Column) -> Column:
    """Mean from a sum and a count, null for an empty group.

    Dividing last keeps sums of decimals exact, and lets partial sums be merged.
    """
    return F.try_divide(total.cast("double"), n.cast("double"))


def rows() -> Column:
    return F.count(F.lit(1))


def safe_sum(df: DataFrame, column: str) -> Column:
    """The sum of a column; large whole numbers are summed as decimals, which do not overflow."""
    large = isinstance(df.schema[column].dataType, T.LongType)
    return F.sum(F.col(column).cast("decimal(38,0)") if large else F.col(column))
