"""Tables stored by key, so that joins and windows on the key need no exchange (K2 with J1-J6, W3, W7).

Every table of a set is hashed on its key into the same number of buckets, one sorted file each. Spark then knows how the rows lie: a
join, an aggregate or a window on the key works bucket by bucket. A layout, stored beside the data, tells the next
session how to read it.

A bucket is read by one task, so a hot key would make one task slow. The largest key of each table is counted when it is
written, and a table with a hot key is opened without its buckets: it is shuffled as any other table, and adaptive execution splits the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaframe.functions.columns import quoted
from plazaframe.functions.measures import rows
from plazaframe.operators.skew import HOT_ROWS

LAYOUT = "name string, key string, order array<string>, buckets int, largest long, columns string"
_LAYOUTS = "layouts"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)


def write_copartitioned(
    frames: Mapping[str, DataFrame], folder: str, keys: Mapping[str, str], buckets: int, *, order: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Write each table to ``<folder>/<name>``, hashed on its key and sorted by key and ``order``; returns the layouts.

    ``keys`` names the key column of each table; keys of tables that are to be joined must have one type. Tables that were
    there are replaced, and so are their layouts; layouts of other tables in the folder stay. Null keys are kept.
    """
    spark = next(iter(frames.values())).sparkSession
    made = []
    for name, df in frames.items():
        key, then = keys[name], [c for c in (order or {}).get(name, []) if c != keys[name]]
        table = f"plazaframe_{uuid.uuid4().hex}"
        # rows of a bucket meet in one task first, so that a bucket is one file
        dealt = df.repartition(buckets, F.expr(quoted(key)))
        dealt.write.format("parquet").mode("overwrite").option("path", f"{folder}/{name}").bucketBy(buckets, key).sortBy(key, *then).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay, and so does the layout
        stored = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        largest = stored.groupBy(F.expr(quoted(key)).alias("k")).agg(rows().alias("n")).agg(F.max("n")).first()[0] or 0
        made.append((name, key, list(then), buckets, largest, _columns(df)))
    known = {row["name"]: tuple(row) for row in _layouts(spark, folder)} | {row[0]: row for row in made}
    spark.createDataFrame(list(known.values()), LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_LAYOUTS}")
    return spark.createDataFrame(made, LAYOUT)


def _layouts(spark: SparkSession, folder: str) -> list:
    try:
        return spark.read.schema(LAYOUT).parquet(f"{folder}/{_LAYOUTS}").collect()  # one row per table
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def open_copartitioned(spark: SparkSession, folder: str, names: Sequence[str] | None = None, *, hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """The tables of a folder, with their buckets unless one of their keys has more than ``hot_rows`` rows."""
    found = {}
    layouts = {row["name"]: row for row in _layouts(spark, folder)}
    for name in names if names is not None else layouts:
        if name not in layouts:
            raise ValueError(f"no layout of a table {name!r} in {folder}")
        layout = layouts[name]
        if layout["largest"] > hot_rows:
            found[name] = spark.read.schema(layout["columns"]).parquet(f"{folder}/{name}")
            continue
        table, key = f"plazaframe_{uuid.uuid4().hex}", quoted(layout["key"])
        by = ", ".join([key, *map(quoted, layout["order"])])
        spark.sql(
            f"CREATE TABLE {table} ({layout['columns']}) USING parquet CLUSTERED BY ({key}) SORTED BY ({by}) "
            f"INTO {layout['buckets']} BUCKETS LOCATION '{folder}/{name}'"
        )
        found[name] = spark.table(table)
        found[name].schema  # resolved, so that the entry in the catalogue can go; the files stay
        spark.sql(f"DROP TABLE {table}")
    return found


def join_in_place(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join two stored tables, or results grouped by their keys, bucket by bucket.

    A merge join keeps the rows where they are, so results of any size on both sides need neither an exchange nor a broadcast.
    """
    return left.join(right.hint("merge"), left[left_key] == right[right_key], how)
