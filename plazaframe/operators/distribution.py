"""Quartiles and value distributions over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaframe.functions.columns import literal, missing, missing_sql, quoted
from plazaframe.functions.measures import rows
from plazaframe.operators.cleaning import accuracy
from plazaframe.operators.durable import materialise
from plazaframe.operators.quantiles import exact_quantiles

# Most distinct values shown one by one, and the range of the number of bins.
MOST_LEVELS = 30
FEWEST_BINS, MOST_BINS = 10, 40

# A sketch that counts this many levels cannot have been shown 30.
SURELY_MANY = 1000


BOXES = "column string, q1 double, median double, q3 double"


def quartiles(df: DataFrame, columns: Sequence[str], relative_error: float | None = None) -> DataFrame:
    """First quartile, median and third quartile per numeric column, null and NaN left out.

    Exact; with ``relative_error`` from a sketch, in one pass, whose ranks are off by at most that
    share of the rows.
    """
    if relative_error is None:
        found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        return df.sparkSession.createDataFrame([(c, *found[c]) for c in columns], BOXES)
    if not columns:
        return df.sparkSession.createDataFrame([], BOXES)
    cells = []
    for c in columns:
        known = f"CASE WHEN NOT {missing_sql(df, c)} THEN CAST({quoted(c)} AS DOUBLE) END"
        cells.append(f"percentile_approx({known}, array(0.25, 0.5, 0.75), {accuracy(relative_error)}) AS q{len(cells)}")
    found = df.selectExpr(*cells)
    boxes = [f"struct({literal(c)} AS column, q{i}[0] AS q1, q{i}[1] AS median, q{i}[2] AS q3)" for i, c in enumerate(columns)]
    return found.selectExpr(f"inline(array({', '.join(boxes)}))")


def degenerate(df: DataFrame, column: str) -> bool:
    """True if a histogram would have a single bar: fewer than two distinct values."""
    known = df.filter(~missing(df, column)).agg(F.min(column).eqNullSafe(F.max(column)).alias("same"))
    return known.first()["same"]


def _one_by_one(levels: DataFrame, column: str, top: int | None) -> DataFrame:
    chosen = levels if top is None else levels.orderBy(F.desc("count"), column).limit(top)
    return chosen.orderBy(column).select(
        F.lit(None).cast("int").alias("bin"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.col(column).cast("string").alias("value"),
        "count",
    )


def distribution(df: DataFrame, column: str, *, top: int | None = None) -> DataFrame:
    """How the values of a column are spread: bin, low, high, value, count.

    Up to 30 distinct values are counted one by one (``value``, in order); beyond that a number is
    put into min(40, max(10, sqrt(n))) bins of equal width, the last one closed above.  Null, NaN
    and infinite values are left out; empty bins are not listed.  Texts are always counted one by one, in a single pass; of a
    column with very many ask for the ``top`` most frequent only (ties go to the smaller value).
    """
    known = df.filter(~missing(df, column)).select(column)
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    if isinstance(df.schema[column].dataType, T.FractionalType):
        known = known.filter(F.abs(F.col(column).cast("double")) < F.lit(float("inf")))
    levels = known.groupBy(column).agg(rows().alias("count"))
    if not numeric:
        return _one_by_one(levels, column, top)
    value = F.col(column).cast("double")
    ends = known.agg(
        F.min(value).alias("low"), F.max(value).alias("high"), rows().alias("n"), F.approx_count_distinct(column).alias("levels")
    ).first()
    # Only when the sketch sees few levels, so that they are a small table, are they counted exactly and written.
    if ends["levels"] <= SURELY_MANY:
        levels = materialise(levels)
        if levels.limit(MOST_LEVELS + 1).count() <= MOST_LEVELS:
            return _one_by_one(levels, column, top)
    bins = min(MOST_BINS, max(FEWEST_BINS, int(ends["n"] ** 0.5)))
    low, width = ends["low"], (ends["high"] - ends["low"]) / bins
    number = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = known.groupBy(number.alias("bin")).agg(rows().alias("count"))
    return counted.orderBy("bin").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.lit(None).cast("string").alias("value"),
        "count",
    )
