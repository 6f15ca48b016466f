"""Column expressions over arrays that several native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, where ``value`` is computed once however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def prefix_sums(numbers: Column) -> Column:
    """The running sums of an array of numbers, in log2(size) passes over it."""

    def step(sums: Column, power: Column) -> Column:
        back = F.pow(F.lit(2), power).cast("int")
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(F.lit(0).cast("long")))

    def scan(x: Column) -> Column:
        passes = F.ceil(F.log2(F.size(x))).cast("int")
        return F.when(F.size(x) < 2, x).otherwise(F.aggregate(F.sequence(F.lit(0), passes - 1), x, step))

    return let(F.transform(numbers, lambda x: x.cast("long")), scan)
