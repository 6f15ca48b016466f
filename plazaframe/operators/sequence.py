"""Running totals and previous values per key (W6, W7, X6), whatever the size of a key.

Ordinary keys use a plain window.  The rows of a hot key are cut into slices that follow each
other in order (a range partitioning), each slice is worked on by itself, and what one slice
has to know of the slices before it is carried over in a table of a few rows per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable
from plazaframe.functions.measures import rows
from plazaframe.operators.durable import materialise, settled
from plazaframe.operators.skew import HOT_ROWS, attach, hot_keys, split_rows

# Helper columns.
_SLICE, _COPIES, _COPY, _AMOUNT, _TOTAL = "_slice", "_copies", "_copy", "_amount", "_total"
_BEFORE, _CARRY = "_before", "_carry"

# Identical rows that one task may write out again.
_CHUNK = 1_000_000


def full_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """``order`` ascending, then every other column, so that only identical rows still tie."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return [F.col(c).asc() for c in order] + [comparable(df, c).asc() for c in rest]


def cut_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slices: int) -> DataFrame:
    """Rows tagged with the slice they fall into when sorted by key and order.

    No two rows may tie, or no cut could fall between them.  The tagged rows are written down, so
    that every later pass sees the same tags.
    """
    ranged = df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
    return materialise(ranged.withColumn(_SLICE, F.spark_partition_id()))


def total_before(cut: DataFrame, keys: Sequence[str], order: Sequence[Column], amount: str) -> DataFrame:
    """Add ``_before``: the sum of ``amount`` over the rows of the same key that come earlier.

    ``keys`` may be empty, for one running total over the table.
    """
    earlier = Window.unboundedPreceding, -1
    by_slice = cut.groupBy(_SLICE, *keys).agg(F.sum(amount).alias(_TOTAL))
    # One row per slice, and one more for each key that starts inside a slice.
    in_turn = (Window.partitionBy(*keys) if keys else Window).orderBy(_SLICE).rowsBetween(*earlier)
    carry = by_slice.select(_SLICE, *keys, F.coalesce(F.sum(_TOTAL).over(in_turn), F.lit(0)).alias(_CARRY))
    within = Window.partitionBy(_SLICE, *keys).orderBy(*order).rowsBetween(*earlier)
    local = cut.withColumn(_BEFORE, F.coalesce(F.sum(amount).over(within), F.lit(0)))
    joined = attach(local, materialise(carry), [_SLICE, *keys])
    return joined.withColumn(_BEFORE, F.col(_BEFORE) + F.col(_CARRY)).drop(_CARRY, _SLICE)


def _pack(df: DataFrame) -> DataFrame:
    """One row per set of identical rows, with their number."""
    return df.groupBy(*df.columns).agg(rows().alias(_COPIES))


def _unpack(df: DataFrame, most: int, slices: int) -> DataFrame:
    """The identical rows again, numbered from 1; a large set is spread over many tasks.

    ``most`` is the size of the largest set.
    """
    if most == 1:
        return df.withColumn(_COPY, F.lit(1)).drop(_COPIES)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(_COPIES) - 1) / _CHUNK))))
    spread = chunks.repartition(slices) if most > _CHUNK else chunks
    first = F.col("_chunk") * _CHUNK + 1
    last = F.least(first + (_CHUNK - 1), F.col(_COPIES))
    return spread.withColumn(_COPY, F.explode(F.sequence(first, last))).drop("_chunk", _COPIES)


def _largest(cut: DataFrame) -> int:
    return cut.agg(F.max(_COPIES)).first()[0]


def _by_heat(
    df: DataFrame,
    keys: Sequence[str],
    hot_rows: int,
    slices: int | None,
    ordinary: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    df = settled(df)
    hot = hot_keys(df, keys, hot_rows=hot_rows, slices=slices)
    if hot is None:
        return ordinary(df)
    listed, parts = hot
    heavy, light = split_rows(df, keys, listed)
    return ordinary(light).unionByName(sliced(heavy, parts))


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counted: str,
    out: str,
    *,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Non-null values of ``counted`` from the key's first row up to this one, in ``order``."""

    def ordinary(part: DataFrame) -> DataFrame:
        so_far = Window.partitionBy(*keys).orderBy(*full_order(df, keys, order))
        frame = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn(out, F.count(counted).over(frame))

    def sliced(part: DataFrame, n: int) -> DataFrame:
        packed = _pack(part).withColumn(_AMOUNT, F.when(F.col(counted).isNull(), 0).otherwise(F.col(_COPIES)))
        placed = full_order(df, keys, order)
        cut = cut_in_order(packed, keys, placed, n)
        told = _unpack(total_before(cut, keys, placed, _AMOUNT), _largest(cut), n)
        own = F.when(F.col(counted).isNull(), 0).otherwise(F.col(_COPY))
        return told.select(*df.columns, (F.col(_BEFORE) + own).alias(out))

    return _by_heat(df, keys, hot_rows, slices, ordinary, sliced)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    *,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """``value`` of the key's row just before this one in ``order``; null for the first row."""

    def ordinary(part: DataFrame) -> DataFrame:
        in_turn = Window.partitionBy(*keys).orderBy(*full_order(df, keys, order))
        return part.withColumn(out, F.lag(value).over(in_turn))

    def sliced(part: DataFrame, n: int) -> DataFrame:
        placed = full_order(df, keys, order)
        cut = cut_in_order(_pack(part), keys, placed, n)
        # Boxed, so that a null value differs from no row at all.
        boxed = F.struct(F.col(value).alias("v"))
        place = F.struct(*order, *[comparable(df, c) for c in df.columns if c not in keys and c not in order])
        ends = cut.groupBy(_SLICE, *keys).agg(F.max_by(boxed, place).alias("_last"))
        over_slices = Window.partitionBy(*keys).orderBy(_SLICE)
        carry = ends.select(_SLICE, *keys, F.lag("_last").over(over_slices).alias(_CARRY))
        within = Window.partitionBy(_SLICE, *keys).orderBy(*placed)
        local = cut.withColumn(_BEFORE, F.lag(boxed).over(within))
        joined = attach(local, materialise(carry), [_SLICE, *keys])
        first_copy = F.coalesce(_BEFORE, _CARRY)["v"]
        told = F.when(F.col(_COPY) == 1, first_copy).otherwise(F.col(value))
        return _unpack(joined, _largest(cut), n).select(*df.columns, told.alias(out))

    return _by_heat(df, keys, hot_rows, slices, ordinary, sliced)
