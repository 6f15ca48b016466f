"""Validation and profiling reports, as DataFrames (V1-V9, V12, G6-G8, G12, G15, UN1)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaframe.functions.columns import literal, numeric_columns, present, quoted, string_columns
from plazaframe.functions.measures import rows
from plazaframe.operators.reducing import sample_rows


def stacked(reports: Iterable[DataFrame]) -> DataFrame:
    """One report out of several with the same columns."""
    return reduce(DataFrame.unionByName, reports)


def _spread_out(summary: DataFrame, cells: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """A one-row summary as one row per cell; a cell is a list of SQL values for ``names``."""
    boxes = (", ".join(f"{value} AS {quoted(name)}" for value, name in zip(cell, names)) for cell in cells)
    return summary.selectExpr(f"inline(array({', '.join(f'struct({box})' for box in boxes)}))")


def overview(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    return stacked(
        df.agg(rows().alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        for name, df in frames.items()
    )


def null_report(
    df: DataFrame,
    table: str,
    *,
    keys: Sequence[str] = (),
    keys_only: bool = False,
    sample_fraction: float | None = None,
) -> DataFrame:
    """Null count and fraction (6 decimals) per column, most nulls first; one pass for all columns.

    ``keys_only`` looks at the key columns, or at all if the table has none of them.  A table
    without rows has an empty report.
    """
    names = (present(df, keys) if keys_only else []) or df.columns
    counts = [f"count_if({quoted(c)} IS NULL) AS n{i}" for i, c in enumerate(names)]
    summary = sample_rows(df, sample_fraction).selectExpr("count(1) AS n", *counts).filter("n > 0")
    cells = [[literal(c), "n", f"n{i}", f"round(n{i} / n, 6)", literal(table)] for i, c in enumerate(names)]
    columns = ["column", "n_rows", "null_count", "null_fraction", "table"]
    return _spread_out(summary, cells, columns).orderBy(F.desc("null_fraction"), "column")


def duplicate_report(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows; keys are counted up before the shuffle.

    Without all of the keys no row counts as a duplicate.
    """
    if not keys or len(present(df, keys)) < len(keys):
        total = df.agg(rows().alias("total_rows"))
        found = total.select("total_rows", F.col("total_rows").alias("distinct_key_rows"))
        shown = F.lit(None).cast("string")
    else:
        found = df.groupBy(*keys).agg(rows().alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), rows().alias("distinct_key_rows")
        )
        shown = F.lit(",".join(keys))
    return found.select(
        F.lit(table).alias("table"),
        "total_rows",
        "distinct_key_rows",
        (F.col("total_rows") - F.col("distinct_key_rows")).alias("duplicate_rows"),
        shown.alias("keys"),
    )


def duplicate_reports(frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return stacked(duplicate_report(df, name, keys.get(name, ())) for name, df in frames.items())


def describe_numbers(
    df: DataFrame, *, sample_fraction: float | None = None, not_ending: Iterable[str] = ()
) -> DataFrame | None:
    """count, mean, stddev, min, quartiles and max of every numeric column; None without any."""
    columns = numeric_columns(df, not_ending=not_ending)
    return sample_rows(df, sample_fraction).select(*columns).summary() if columns else None


# Metric -> aggregate function.
_NUMBERS = {"min": "min", "max": "max", "mean": "avg", "stddev": "stddev"}


def _number_measures(names: Iterable[str], places: Mapping[str, int]) -> list[str]:
    return [f"{f}({quoted(c)}) AS {metric}{places[c]}" for c in names for metric, f in _NUMBERS.items()]


def numeric_stats(df: DataFrame) -> DataFrame:
    """min, max, mean and sample deviation (4 decimals) of every numeric column, in one pass; no rows without any."""
    places = {c: i for i, c in enumerate(numeric_columns(df))}
    if not places:
        return df.sparkSession.createDataFrame([], "column string, min double, max double, mean double, stddev double")
    summary = df.selectExpr(*_number_measures(places, places))
    ends = [[f"CAST({m}{i} AS DOUBLE)" for m in ("min", "max")] for i in places.values()]
    moments = [[f"round(CAST({m}{i} AS DOUBLE), 4)" for m in ("mean", "stddev")] for i in places.values()]
    cells = [[literal(c), *low_high, *rounded] for c, low_high, rounded in zip(places, ends, moments)]
    return _spread_out(summary, cells, ["column", *_NUMBERS])


def string_distinct(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Distinct values per text column, null being one of them; 0 in an empty table, no rows without text columns.

    Exact counts send each distinct (column, value) pair once per task, long values as their
    256-bit digests; the approximate ones send one sketch per task.
    """
    columns = string_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, distinct_count bigint")
    if exact:
        short = [f"CASE WHEN length({quoted(c)}) < 64 THEN {quoted(c)} ELSE sha2({quoted(c)}, 256) END AS {quoted(c)}" for c in columns]
        pairs = df.selectExpr(*short).unpivot([], columns, "column", "value").distinct()
        counted = pairs.groupBy("column").agg(rows().alias("distinct_count"))
        named = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
        return named.join(counted, "column", "left").fillna(0, ["distinct_count"])
    sketches = [
        f"approx_count_distinct({quoted(c)}) + max(CAST({quoted(c)} IS NULL AS INT)) AS n{i}" for i, c in enumerate(columns)
    ]
    cells = [[literal(c), f"coalesce(n{i}, 0)"] for i, c in enumerate(columns)]
    return _spread_out(df.selectExpr(*sketches), cells, ["column", "distinct_count"])


def validation_report(df: DataFrame, name: str, *, exact: bool = True) -> DataFrame:
    """Everything known about a table, one row per (column, metric); table-wide metrics have no column.

    Metrics: ``rows``, ``columns``; per column ``type``, ``null_count``, ``null_percentage`` (2
    decimals); ``min``, ``max``, ``mean``, ``stddev`` of numbers; ``distinct_count`` of texts.
    A frame without columns yields one ``error`` row.
    """
    columns = ["table", "column", "metric", "value"]
    if not df.columns:
        return _spread_out(df.sparkSession.range(1), [[literal(name), "CAST(NULL AS STRING)", "'error'", "'no columns'"]], columns)
    places = {c: i for i, c in enumerate(df.columns)}
    numbers = numeric_columns(df)
    nulls = [f"count_if({quoted(c)} IS NULL) AS null{i}" for c, i in places.items()]
    summary = df.selectExpr("count(1) AS n", *nulls, *_number_measures(numbers, places))
    found = [("CAST(NULL AS STRING)", "rows", "n"), ("CAST(NULL AS STRING)", "columns", str(len(places)))]
    for c, i in places.items():
        found.append((literal(c), "type", literal(df.schema[c].dataType.simpleString())))
        found.append((literal(c), "null_count", f"null{i}"))
        found.append((literal(c), "null_percentage", f"coalesce(round(try_divide(null{i} * 100.0D, n), 2), 0.0D)"))
    for c in numbers:
        found += [(literal(c), m, f"{m}{places[c]}") for m in ("min", "max")]
        found += [(literal(c), m, f"round(CAST({m}{places[c]} AS DOUBLE), 4)") for m in ("mean", "stddev")]
    report = _spread_out(summary, [[literal(name), c, literal(m), f"CAST({v} AS STRING)"] for c, m, v in found], columns)
    if not string_columns(df):
        return report
    texts = string_distinct(df, exact=exact).selectExpr(
        f"{literal(name)} AS table", "column", "'distinct_count' AS metric", "CAST(distinct_count AS STRING) AS value"
    )
    return report.unionByName(texts)


def validation_dict(report: DataFrame) -> dict[str, Any]:
    """A validation report as nested dictionaries: metric -> value, and column -> metric -> value.

    A report has a few rows per column of the table, whatever the table's size.
    """
    found: dict[str, Any] = {"columns": {}}
    for row in report.collect():
        place = found if row["column"] is None else found["columns"].setdefault(row["column"], {})
        place["column_count" if row["column"] is None and row["metric"] == "columns" else row["metric"]] = row["value"]
    return found


def validate_tables(
    spark: SparkSession, openers: Mapping[str, Callable[[], DataFrame]], *, exact: bool = True
) -> tuple[dict[str, dict[str, Any]], DataFrame]:
    """Open and validate each table; a failure is noted and the next table follows.

    Returns the reports by table, and one status row (table, ok, error) per table.
    """
    reports, status = {}, []
    for name, opened in openers.items():
        try:
            reports[name] = validation_dict(validation_report(opened(), name, exact=exact))
            status.append((name, True, None))
        except Exception as problem:  # noqa: BLE001 - the point is to go on with the next table
            status.append((name, False, str(problem)))
    return reports, spark.createDataFrame(status, "table string, ok boolean, error string")


def impact(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table before and after preparation, and what changed."""

    def one(name: str) -> DataFrame:
        old, new = before[name], after[name]
        had, has = set(old.columns), set(new.columns)
        counted = old.agg(rows().alias("n")).select(F.lit("raw").alias("side"), "n").unionByName(
            new.agg(rows().alias("n")).select(F.lit("processed").alias("side"), "n")
        )
        sides = {side: F.sum(F.when(F.col("side") == side, F.col("n"))) for side in ("raw", "processed")}
        numbers = {
            "raw_cols": len(old.columns),
            "proc_cols": len(new.columns),
            "delta_cols": len(new.columns) - len(old.columns),
            "added_cols": len(has - had),
            "removed_cols": len(had - has),
        }
        return counted.agg(sides["raw"].alias("raw_rows"), sides["processed"].alias("proc_rows")).select(
            F.lit(name).alias("table"),
            "raw_rows",
            "proc_rows",
            (F.col("proc_rows") - F.col("raw_rows")).alias("delta_rows"),
            *(F.lit(v).cast("long").alias(k) for k, v in numbers.items()),
        )

    return stacked(one(name) for name in before if name in after)
