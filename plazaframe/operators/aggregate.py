"""Grouped aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.measures import mean_from, safe_sum
from plazaframe.operators.skew import attach

Named = Mapping[str, str]


def group_stats(df: DataFrame, by: Sequence[str], *, counts: Named = {}, sums: Named = {}, means: Named = {}) -> DataFrame:
    """Per group: non-null counts, sums and means, each given as result name -> column."""
    return df.groupBy(*by).agg(
        *(F.count(c).alias(out) for out, c in counts.items()),
        *(F.sum(c).alias(out) for out, c in sums.items()),
        *(mean_from(safe_sum(df, c), F.count(c)).alias(out) for out, c in means.items()),
    )


def stats_by_attribute(
    fact: DataFrame, dimension: DataFrame, key: str, by: Sequence[str], *, counts: Named = {}, means: Named = {}, selective: bool = False
) -> DataFrame:
    """Counts and means of a fact table, grouped by attributes of the dimension it points to.

    The fact is reduced to one row per key before it is joined, so a key with a huge number of
    facts costs no more than any other, and the partial sums are merged afterwards.  A key that
    the dimension lists twice counts twice, as in the plain join.  Where the dimension is filtered
    down to few keys (``selective``), facts of other keys go before they are reduced.
    """
    if selective:
        fact = fact.join(dimension.select(key), key, "left_semi")
    parts = fact.groupBy(key).agg(
        *(F.count(c).alias(f"_count_{out}") for out, c in counts.items()),
        *(safe_sum(fact, c).alias(f"_sum_{out}") for out, c in means.items()),
        *(F.count(c).alias(f"_size_{out}") for out, c in means.items()),
    )
    attributes = list(dict.fromkeys([key, *by]))
    return (
        parts.join(dimension.select(*attributes), key)
        .groupBy(*by)
        .agg(
            *(F.sum(f"_count_{out}").alias(out) for out in counts),
            *(mean_from(F.sum(f"_sum_{out}"), F.sum(f"_size_{out}")).alias(out) for out in means),
        )
    )


def with_group_mean(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the mean of ``value`` over the row's group.

    The answer of ``avg(...) over (partition by ...)``, but a group's rows are never gathered:
    means are computed with map-side partial sums and looked up.
    """
    means = group_stats(df.select(*by, value), by, means={out: value})
    return attach(df, means, by)
