"""Comparing two states of a table by key (V9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable, quoted
from plazaframe.functions.measures import rows

# Names that no column of a compared table has.
_ROWS, _SIDE = "_rows", "_side"


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: how many rows it has, and for each column the sum of the digests of its values.

    Sums do not depend on the order of rows, so keys that repeat are compared as sets of rows, and tasks add up their
    own rows before the shuffle. A null counts as a value.
    """
    sums = [F.sum(F.xxhash64(F.lit(c), comparable(df, c), F.expr(f"{quoted(c)} IS NULL")).cast("decimal(38,0)")).alias(f"_d{i}") for i, c in enumerate(columns)]
    return df.groupBy(*(F.expr(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys))).agg(rows().alias(_ROWS), *sums)


def changed_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that differ: state (``added``, ``removed`` or ``changed``), rows_before, rows_after, and the columns that changed.

    Both tables are reduced to digests per key and joined in full on the key, null matching null; keys that are equal do not come
    back. Columns that only one table has are not compared, and a column whose type changed is compared as text.
    A key whose number of rows changed has changed; its columns are those whose digests differ.
    """
    missing = [k for k in keys if k not in before.columns or k not in after.columns]
    if missing or not keys:
        raise ValueError(f"both tables need the key columns {missing or 'of the comparison'}")
    columns = [c for c in before.columns if c in after.columns and c not in keys]
    retyped = [c for c in columns if before.schema[c].dataType != after.schema[c].dataType]
    sides = [df.withColumns({c: F.expr(quoted(c)).cast("string") for c in retyped}) for df in (before, after)]
    left, right = (_digests(df, keys, columns) for df in sides)
    names = [f"_k{i}" for i in range(len(keys))]
    same_key = F.lit(True)
    for n in names:
        same_key = same_key & left[n].eqNullSafe(right[n])
    differs = [F.when(~left[f"_d{i}"].eqNullSafe(right[f"_d{i}"]), F.lit(c)) for i, c in enumerate(columns)]
    state = F.when(left[_ROWS].isNull(), "added").when(right[_ROWS].isNull(), "removed").otherwise("changed")
    listed = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    joined = left.join(right, same_key, "full").select(
        *(F.when(left[_ROWS].isNull(), right[n]).otherwise(left[n]).alias(k) for n, k in zip(names, keys)),
        state.alias("state"),
        F.coalesce(left[_ROWS], F.lit(0)).alias("rows_before"),
        F.coalesce(right[_ROWS], F.lit(0)).alias("rows_after"),
        listed.alias("columns"),
    )
    unlike = (F.col("state") != "changed") | (F.col("rows_before") != F.col("rows_after")) | (F.size("columns") > 0)
    return joined.where(unlike).withColumn("columns", F.when(F.col("state") == "changed", F.col("columns")))


def change_report(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys and rows were added, removed and changed, and how many changed in each column: state, column, keys, rows_before, rows_after.

    A line without a column counts keys; states and columns without any key are not listed.
    """
    found = changed_keys(before, after, keys).select("state", "rows_before", "rows_after", "columns")
    # a null stands for the key itself beside the columns that changed
    each = found.withColumn("column", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("columns", F.array().cast("array<string>")))))
    report = each.groupBy("state", "column").agg(rows().alias("keys"), F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
    return report.orderBy("state", "column")
