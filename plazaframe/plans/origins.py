"""From which columns of a loaded table each prepared column comes (K4).

The stages are applied to a table that has the columns but no rows, and Catalyst is asked which of them are left once it has pruned what a
result column does not need. So the answer comes from the very expressions that prepare the data, and no data is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaframe.functions.columns import quoted
from plazaframe.operators import scaling
from plazaframe.operators.durable import materialise
from plazaframe.operators.flattening import flatten
from plazaframe.plans.preparation import Settings, settings_for, transform

EDGES = "table string, stage string, column string, sources array<string>"


def sources_of(df: DataFrame, column: str) -> list[str]:
    """The columns of the one stored table below ``df`` that ``column`` is computed from."""
    leaves = df.select(F.expr(quoted(column))).where(F.expr(f"{quoted(column)} IS NOT NULL"))._jdf.queryExecution().sparkPlan().collectLeaves()
    output = leaves.head().output()
    return sorted(output.apply(i).name() for i in range(output.size()))


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return materialise(spark.createDataFrame([], schema))


def edges(spark: SparkSession, schema: T.StructType, table: str, settings: Settings | None = None) -> list[tuple[str, str, str, list[str]]]:
    """(table, stage, column, source columns before the stage) for every column after each stage that has columns of its own.

    Cleaning, pruning and the screen keep or drop columns and change none into another, so their edges lead from a column to itself; which
    columns the screen drops only the data can tell.
    """
    if not schema.names:
        return []
    given = settings or settings_for(table, None)
    found = [(table, "clean", c, [c]) for c in schema.names]
    loaded = _empty(spark, schema)
    flat = flatten(loaded, table, given.fill_text)
    found += [(table, "flatten", c, sources_of(flat, c)) for c in flat.columns]
    pruned = flat.drop(*given.prune)
    found += [(table, stage, c, [c]) for stage in ("prune", "screen") for c in pruned.columns]
    before = _empty(spark, pruned.schema)
    columns = scaling.scalable(before, given.scale_exclude)
    # any range will do: what a scaled column is computed from does not depend on it
    ranges = scaling.Measures(rows=2, constant=[], low=dict.fromkeys(columns, 0.5), high=dict.fromkeys(columns, 2.5), mean=dict.fromkeys(columns, 0.5), spread=dict.fromkeys(columns, 2.0))
    after = transform(before, given, ranges)
    found += [(table, "transform", c, sources_of(after, c)) for c in after.columns]
    if given.components:
        own = scaling.scalable(after, [*given.scale_exclude, *(f"{c}_bin" for c in given.bins)])
        found += [(table, "reduce", c, [c]) for c in after.columns] + [(table, "reduce", "components", own)]
    return found


def edge_table(spark: SparkSession, schemas: Mapping[str, T.StructType], settings: Mapping[str, Settings] | None = None) -> DataFrame:
    """The edges of several tables."""
    return spark.createDataFrame([e for t, s in schemas.items() for e in edges(spark, s, t, settings_for(t, settings))], EDGES)


def origins(found: list[tuple[str, str, str, list[str]]]) -> dict[str, list[str]]:
    """For every column after the last stage the columns of the loaded table that it comes from, through all stages."""
    stages = list(dict.fromkeys(stage for _, stage, _, _ in found))
    known: dict[str, list[str]] | None = None
    for stage in stages:
        step = {column: sources for _, s, column, sources in found if s == stage}
        known = step if known is None else {c: sorted({o for s in sources for o in known[s]}) for c, sources in step.items()}
    return known or {}
