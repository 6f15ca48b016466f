"""Finding hot groups, and joining small results back to their rows.

A window over a key puts every row of that key into one task.  That is fine until one key holds
a large part of the table, so the operators in ``sequence`` ask here first which keys do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.measures import rows
from plazaframe.operators.durable import materialise

# A group of at most this many rows is never worth splitting.
HOT_ROWS = 2_000_000


def slice_count(df: DataFrame, number: int) -> int:
    """How many parts to cut ``number`` rows into.

    A few per shuffle task, so that tasks even out; more where parts would still be large.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * width, number // HOT_ROWS)


def hot_keys(
    df: DataFrame, keys: Sequence[str], *, hot_rows: int = HOT_ROWS, slices: int | None = None
) -> tuple[DataFrame, int] | None:
    """Keys holding more than ``hot_rows`` rows, whatever the size of the table, and the number of slices for their rows.

    None if there are no such keys, which one pass over the key columns tells: rows are counted
    per key before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(rows().alias("_n"))
    hot = F.col("_n") > hot_rows
    seen = per_key.agg(F.max("_n").alias("largest"), F.coalesce(F.sum(F.when(hot, F.col("_n"))), F.lit(0)).alias("rows")).first()
    if (seen["largest"] or 0) <= hot_rows:
        return None
    return materialise(per_key.filter(hot).select(*keys)), slices or slice_count(df, seen["rows"])


def _on(keys: Sequence[str], prefix: str) -> Column:
    """Equality on all keys, null matching null."""
    first, *rest = [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    for test in rest:
        first = first & test
    return first


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def attach(df: DataFrame, extra: DataFrame, keys: Sequence[str], *, how: str = "inner") -> DataFrame:
    """Bring the other columns of ``extra`` to the rows of ``df`` with the same keys, null = null.

    Catalyst decides by size whether ``extra`` is broadcast, and adaptive execution splits a hot key.
    """
    right = _renamed(extra, keys, "_k_")
    return df.join(right, _on(keys, "_k_"), how).drop(*["_k_" + k for k in keys])


def split_rows(df: DataFrame, keys: Sequence[str], listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is listed, all other rows)."""
    right = _renamed(listed, keys, "_k_")
    return df.join(right, _on(keys, "_k_"), "left_semi"), df.join(right, _on(keys, "_k_"), "left_anti")
