"""Sorted heads, top-k per group and percent rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable
from plazaframe.functions.measures import rows
from plazaframe.operators.durable import is_scan, materialise, settled
from plazaframe.operators.skew import HOT_ROWS, attach, hot_keys, slice_count, split_rows

# Values drawn per slice to find its bounds.
SAMPLED = 200
# Bounds that are compared one by one in generated code; more are searched for in a list.
TREE = 256


def ordered(df: DataFrame, order: Sequence[Column | str], ties: Sequence[str] = ()) -> DataFrame:
    """Sort the whole result; ``ties`` decide between equal rows (and let a hot value be split)."""
    return df.orderBy(*order, *ties)


def first_rows(
    df: DataFrame, n: int, order: Sequence[Column | str], *, ties: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The first ``n`` rows in ``order``: each task keeps its own n, one task merges those.

    ``ties`` (a row's identity) and then the shown columns decide between equal rows, so the
    answer is the same on every run.
    """
    named = [c for c in columns if c not in ties]
    return df.orderBy(*order, *ties, *named).limit(n).select(*columns)


def top_ranked(df: DataFrame, by: Sequence[str], value: str, k: int, out: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose rank by ``value`` (largest first) within ``by`` is at most ``k``, all ties kept.

    Ordinary groups are ranked by a window; each task keeps its own k per group, and their ties, before the shuffle. A group
    above ``hot_rows`` rows could send a crowd of ties into one task. The rank of a value is known from the k largest
    values of its group, so of such groups a narrow pass finds those, and the rows look their rank up. The group sizes take a
    pass over ``by``; an input that costs more than a scan is written first, so that it is computed once.
    """
    df = settled(df) if is_scan(df) else materialise(df)
    largest = Window.partitionBy(*by).orderBy(F.col(value).desc())

    def ordinary(part: DataFrame) -> DataFrame:
        return part.withColumn(out, F.rank().over(largest)).filter(F.col(out) <= k)

    hot = hot_keys(df, by, hot_rows=hot_rows)
    if hot is None:
        return ordinary(df)
    heavy, light = split_rows(df, by, hot[0])
    heads = (
        heavy.select(*by, value)
        .withColumns({"_place": F.row_number().over(largest), out: F.rank().over(largest)})
        .filter(F.col("_place") <= k)
        # The first of equal values stands at its rank; the others are not needed.
        .filter(F.col("_place") == F.col(out))
        .select(*by, value, out)
    )
    return ordinary(light).unionByName(attach(heavy, materialise(heads), [*by, value]))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; every task drops all but one per key beforehand."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], date: str, ties: Sequence[str]) -> DataFrame:
    """The newest row of each key; of several equally new ones the first by ``ties``."""
    rest = [comparable(df, c) for c in df.columns if c not in keys and c not in ties and c != date]
    return one_per_key(df, keys, [F.col(date).desc(), *[F.col(t).asc() for t in ties], *[c.asc() for c in rest]])


def _bounds(df: DataFrame, value: str, slices: int, number: int) -> list:
    """Values that cut ``df`` into about ``slices`` parts of like size, in order, taken from a sample; a frequent value is among them."""
    share = min(1.0, SAMPLED * slices / max(number, 1))
    sample = df.select(value).where(F.col(value).isNotNull()).sample(False, share, 11) if share < 1 else df.select(value).dropna()
    listed = sample.agg(F.sort_array(F.collect_list(value)).alias("v")).first()["v"]
    step = max(1, len(listed) // slices)
    return list(dict.fromkeys(listed[step - 1 :: step]))


def _tree(value: Column, bounds: Sequence, first: int = 0) -> Column:
    """How many bounds lie below a value, as nested comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    below = F.lit(bounds[middle]) < value
    return F.when(below, _tree(value, bounds[middle + 1 :], first + middle + 1)).otherwise(_tree(value, bounds[:middle], first))


def _search(value: Column, bounds: Sequence) -> Column:
    """How many bounds lie below a value, by halving a list."""
    known, n = F.lit(list(bounds)), len(bounds)

    def step(low: Column, width: Column) -> Column:
        return F.when((low + width <= n) & (F.get(known, low + width - 1) < value), low + width).otherwise(low)

    return F.aggregate(F.array(*(F.lit(1 << i) for i in range(n.bit_length())[::-1])), F.lit(0), step)


def percent_rank_over_all(df: DataFrame, value: str, out: str, *, slices: int | None = None) -> DataFrame:
    """``percent_rank`` over the whole table, largest ``value`` first.

    Up to ``HOT_ROWS`` rows are ranked by a plain window, which is a single small task. Beyond that, or where ``slices`` is given, a sample
    gives bounds, and one pass counts the rows between neighbouring bounds and those equal to a bound. These few numbers
    say how many rows come before each slice. A value that is a bound, as every frequent value is, has its rank from them, and
    its rows go to as many tasks as there are slices; the rows between two bounds are ranked in a window of their own. Nulls are equal
    and come last.
    """
    df = settled(df)
    number = df.count()
    falling = F.col(value).desc()
    if slices is None and number <= HOT_ROWS:
        return df.withColumn(out, F.percent_rank().over(Window.orderBy(falling)))
    width = slices or slice_count(df, number)
    bounds = _bounds(df, value, width, number)
    if not bounds:  # no value is known: all rows are equal
        return df.withColumn(out, F.lit(0.0))
    found = _tree(F.col(value), bounds) if len(bounds) <= TREE else _search(F.col(value), bounds)
    placed = df.withColumn("_slice", F.when(F.col(value).isNull(), -1).otherwise(found))
    placed = placed.withColumn("_equal", F.col(value).isNull() | F.get(F.lit(bounds), F.col("_slice")).eqNullSafe(F.col(value)))
    counts = {(r["_slice"], r["_equal"]): r["n"] for r in placed.groupBy("_slice", "_equal").agg(rows().alias("n")).collect()}
    before, so_far = {}, 0
    for part in [(i, e) for i in range(len(bounds), -1, -1) for e in (True, False)] + [(-1, True)]:
        before[part] = so_far  # a bound is larger than what lies between it and the bound below
        so_far += counts.get(part, 0)
    listed = [F.lit([before[i, e] for i in range(-1 if e else 0, len(bounds) + 1)]) for e in (True, False)]
    start = F.when(F.col("_equal"), F.get(listed[0], F.col("_slice") + 1)).otherwise(F.get(listed[1], F.col("_slice")))
    spread = F.when(F.col("_equal"), F.monotonically_increasing_id() % width).otherwise(F.lit(-1))
    local = placed.withColumn("_part", spread)
    within = F.rank().over(Window.partitionBy("_slice", "_part").orderBy(falling)) - 1  # 0 for rows that equal a bound
    return local.select(*df.columns, ((start + within) / F.lit(max(number - 1, 1))).alias(out))


def percent_rank_head(
    df: DataFrame, value: str, n: int, out: str, *, ties: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The ``n`` rows with the largest ``value`` and their percent rank among all rows.

    Whatever outranks one of these rows is among them, so only they are ranked; of the rest
    only the number is needed.
    """
    others = df.agg(F.greatest(rows() - 1, F.lit(1)).alias("n")).scalar()
    head = first_rows(df, n, [F.col(value).desc()], ties=ties, columns=list(dict.fromkeys([*ties, *columns, value])))
    place = F.rank().over(Window.orderBy(F.col(value).desc()))
    ranked = head.withColumn(out, (place - 1) / others)
    return ranked.orderBy(F.col(value).desc(), *ties).select(*columns, out)
