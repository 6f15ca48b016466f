"""Profiles that are stored per load and merged without reading old rows.

A profile has one row per column: counts, extremes and sums, and two sketches as binary values, one for distinct values (HLL) and one
for the quantiles of numbers (KLL). All of them merge by addition or by union, so the profile of a table is that of
its loads put together, and a new load costs a pass over its own rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaframe.functions.columns import literal, missing_sql, quoted

#: Size of the sketches: HLL with 2 to the 14th registers (a standard error of 0.8 %), KLL of size 800 (ranks within about 0.4 %).
REGISTERS, ITEMS = 14, 800
PROFILE = "load string, column string, kind string, rows long, missing long, low string, high string, least double, most double, total double, squares double, values binary, ranks binary"


def _kind(df: DataFrame, column: str) -> str:
    return "number" if isinstance(df.schema[column].dataType, T.NumericType) else "other"


def profile(df: DataFrame, load: str, columns: Sequence[str] | None = None, *, registers: int = REGISTERS, items: int = ITEMS) -> DataFrame:
    """One row per column of one load; a single pass, whose tasks return a few kilobytes per column.

    Null and NaN are missing and take no further part. Numbers have least, most, total, squares and ranks, other types that can be ordered have low and high, as
    text; maps have counts only. The profile of an empty load has counts of 0 and can be merged like any other.
    """
    cells, measures = [], ["count(1) AS n"]
    for i, c in enumerate(columns if columns is not None else df.columns):
        value, kind = f"CASE WHEN NOT {missing_sql(df, c)} THEN {quoted(c)} END", _kind(df, c)
        ordered = not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))
        number = f"CAST({value} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
        text = f"CAST({value} AS STRING)" if ordered else "CAST(NULL AS STRING)"
        measures += [
            f"count({value}) AS k{i}",
            f"min({text}) AS low{i}" if kind == "other" else f"CAST(NULL AS STRING) AS low{i}",
            f"max({text}) AS high{i}" if kind == "other" else f"CAST(NULL AS STRING) AS high{i}",
            f"min({number}) AS least{i}",
            f"max({number}) AS most{i}",
            f"sum({number}) AS total{i}",
            f"sum({number} * {number}) AS squares{i}",
            f"hll_sketch_agg({text}, {registers}) AS values{i}",
            f"kll_sketch_agg_double({number}, {items}) AS ranks{i}",
        ]
        cells.append(
            f"struct({literal(c)} AS column, '{kind}' AS kind, n AS rows, n - k{i} AS missing, low{i} AS low, high{i} AS high, least{i} AS least, "
            f"most{i} AS most, total{i} AS total, squares{i} AS squares, values{i} AS values, ranks{i} AS ranks)"
        )
    if not cells:
        return df.sparkSession.createDataFrame([], PROFILE)
    found = df.selectExpr(*measures).selectExpr(f"inline(array({', '.join(cells)}))")
    return found.select(F.lit(load).alias("load"), "*")


def merged(profiles: DataFrame) -> DataFrame:
    """One profile out of those of several loads (the same load counts once only); no row of the loads is read."""
    once = profiles.dropDuplicates(["load", "column"])
    return once.groupBy("column", "kind").agg(
        F.concat_ws("+", F.array_sort(F.collect_set("load"))).alias("load"),
        *(F.sum(c).alias(c) for c in ("rows", "missing", "total", "squares")),
        *(F.min(c).alias(c) for c in ("low", "least")),
        *(F.max(c).alias(c) for c in ("high", "most")),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    ).select(*(f.split()[0] for f in PROFILE.split(", ")))


def report(profiles: DataFrame, parts: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What a profile says: column, rows, missing, distinct (estimated), low, high, least, most, mean, stddev, quantiles (estimated)."""
    known = F.col("rows") - F.col("missing")
    mean = F.try_divide("total", known)
    spread = F.try_divide(F.col("squares") - F.col("total") * mean, (known - 1).cast("double"))
    ranks = F.kll_sketch_get_quantile_double("ranks", F.array(*(F.lit(float(p)) for p in parts)))
    number = (F.col("kind") == "number") & (known > 0)
    return profiles.select(
        "column",
        "rows",
        "missing",
        F.hll_sketch_estimate("values").alias("distinct"),
        "low",
        "high",
        "least",
        "most",
        F.when(number, mean).alias("mean"),
        F.when(number & (known > 1), F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("stddev"),
        F.when(number, ranks).alias("quantiles"),
    )
