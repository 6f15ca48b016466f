"""Exact quantiles of numeric columns over tables of any size.

Values are never moved. A small sample tells about where the quantiles lie; a pass over the table divides these intervals into buckets, in
the order of the values, and counts rows per bucket and between the intervals. Each wanted rank points into one bucket, which the next
pass divides again, until it holds a single value. All columns and all ranks share a pass; what leaves a task is one count per bucket it
has seen, with the bucket's smallest and largest value. The sample only saves passes: where it misleads, what it left out is divided.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import missing_sql, quoted
from plazaframe.functions.measures import rows

#: Rows of the sample, about.
SAMPLE = 20_000
#: Buckets an interval is divided into, or each factor of two of a wide one.
BUCKETS, PER_OCTAVE = 2048, 16
_SPAN = 1 << 20  # more than the buckets of an interval


def _by_size(value: Column) -> Column:
    """A bucket by sign and logarithm, rising with the value; infinities have buckets of their own."""
    size = F.least(F.floor(F.log2(F.abs(value)) * PER_OCTAVE), F.lit(1025 * PER_OCTAVE)) + 1076 * PER_OCTAVE  # exponents are above -1076
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)) + _SPAN // 2


def _by_distance(value: Column, low: float, high: float) -> Column:
    """A bucket of equal width, rising with the value; the quotient is 0 and 1 at the ends, whatever is rounded."""
    if low == high:
        return F.lit(0)
    return F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * BUCKETS), F.lit(BUCKETS - 1))


def _bucket(value: Column, intervals: Sequence[tuple[float, float]], gaps: bool) -> Column:
    """A bucket, rising with the value: those of the intervals, which are in order, and with ``gaps`` one before, between and after them each."""
    out = F
    for i, (low, high) in enumerate(intervals):
        narrow = low == high or (0 < low and high <= 4 * low) or (high < 0 and low >= 4 * high)
        bucket = _by_distance(value, low, high) if narrow and abs(low) + abs(high) < 1e308 else _by_size(value)
        out = out.when(value < F.lit(low), F.lit(2 * i * _SPAN if gaps else None)).when(value <= F.lit(high), bucket + (2 * i + 1) * _SPAN)
    return out.when(value.isNotNull(), F.lit(2 * len(intervals) * _SPAN if gaps else None)).cast("long")


def _counts(values: DataFrame, intervals: dict[int, list[tuple[float, float]]], gaps: bool) -> dict[int, list[tuple[int, float, float, int]]]:
    """For each column (bucket, smallest value, largest value, rows), by bucket; one pass over the table."""
    placed = values.select(*(f"v{i}" for i in intervals), *(_bucket(F.col(f"v{i}"), spans, gaps).alias(f"b{i}") for i, spans in intervals.items()))
    cells = F.stack(F.lit(len(intervals)), *(x for i in intervals for x in (F.lit(i), F.col(f"b{i}"), F.col(f"v{i}")))).alias("column", "bucket", "value")
    found = placed.select(cells).where("bucket IS NOT NULL").groupBy("column", "bucket").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), rows().alias("n")
    )
    out: dict[int, list[tuple[int, float, float, int]]] = {i: [] for i in intervals}
    for row in found.collect():  # at most the buckets of one pass, whatever the size of the table
        out[row["column"]].append((row["bucket"], row["low"], row["high"], row["n"]))
    return {i: sorted(listed) for i, listed in out.items()}


def _guesses(values: DataFrame, parts: Sequence[float]) -> list[list[tuple[float, float]]]:
    """For each column the intervals, in order, that its quantiles are likely to lie in."""
    number = values.count()
    sample = values.sample(False, SAMPLE / number, 3) if number > SAMPLE else values
    listed = sample.agg(*(F.sort_array(F.collect_list(c)).alias(c) for c in values.columns)).first()
    out = []
    for known in listed:
        n = len(known)
        slack = 2 + 3 * math.sqrt(n) if n < number else 1
        spans = []
        for p in sorted(parts):
            a, b = math.floor(p * n - slack), math.ceil(p * n + slack)
            low, high = known[a] if a >= 0 else -math.inf, known[b] if b < n else math.inf
            if spans and low <= spans[-1][1]:
                low = spans.pop()[0]  # one that overlaps; high ends rise with the parts
            spans.append((low, high))
        out.append(spans)
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], parts: Sequence[float]) -> dict[str, list[float | None]]:
    """For each column the smallest value at or below which at least each of ``parts`` of its values lie.

    Null and NaN are left out; a column without values gives None. Each pass reads the columns once: the sample, the first division, and as
    a rule one or two more of a few values.
    """
    cells = [f"CASE WHEN NOT {missing_sql(df, c)} THEN CAST({quoted(c)} AS DOUBLE) + 0.0D END AS v{i}" for i, c in enumerate(columns)]
    if not cells:
        return {}
    values = df.selectExpr(*cells)
    found: list[list[float | None]] = [[None] * len(parts) for _ in columns]
    # per column and part: the rank, the bucket that holds it, and how many values of the column lie below that
    open_ranks: dict[tuple[int, int], tuple[int, float, float, int]] = {}

    def place(rank: int, buckets: Sequence[tuple[int, float, float, int]], below: int) -> tuple[int, float, float, int]:
        before = accumulate(buckets, lambda so_far, b: so_far + b[3], initial=below)
        return next((rank, b[1], b[2], n) for b, n in zip(buckets, before) if rank <= n + b[3])

    for i, buckets in _counts(values, dict(enumerate(_guesses(values, parts))), gaps=True).items():
        total = sum(b[3] for b in buckets)
        for j, part in enumerate(parts if total else ()):
            open_ranks[i, j] = place(_rank(part, total), buckets, 0)
    while open_ranks:
        intervals: dict[int, list[tuple[float, float]]] = {}
        for (i, j), (_, low, high, _) in sorted(open_ranks.items(), key=lambda x: x[1][1]):
            if low == high:
                found[i][j] = low
                del open_ranks[i, j]
            elif (low, high) not in intervals.setdefault(i, []):
                intervals[i].append((low, high))  # buckets of one pass, so they do not overlap
        for i, buckets in _counts(values, intervals, gaps=False).items() if intervals else ():
            for (_, j), (rank, low, high, below) in [x for x in open_ranks.items() if x[0][0] == i]:
                at = 2 * intervals[i].index((low, high)) + 1
                open_ranks[i, j] = place(rank, [b for b in buckets if b[0] // _SPAN == at], below)
    return {c: found[i] for i, c in enumerate(columns)}


def _rank(part: float, n: int) -> int:
    """The rank, from 1, of a quantile among ``n`` values; products that are whole but for rounding count as whole."""
    exact = part * n
    return max(1, round(exact) if abs(exact - round(exact)) < 1e-9 * max(1.0, exact) else int(exact) + 1)
