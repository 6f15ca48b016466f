"""Named tables and how to open them."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from plazaframe.functions.columns import present
from plazaframe.functions.measures import rows
from plazaframe.schemas import SCHEMAS


@dataclass(frozen=True)
class Source:
    """Where a table lies and how it is stored; JSON tables declare their schema."""

    path: str
    format: str = "parquet"
    schema: str | None = None  # "name type, name type"


def json_sources(paths: Mapping[str, str]) -> dict[str, Source]:
    """Sources for the six declared tables, given the path of each JSON-lines file or folder."""
    return {name: Source(path, "json", SCHEMAS[name]) for name, path in paths.items()}


def parquet_sources(folder: str, names: Iterable[str], suffix: str = "") -> dict[str, Source]:
    """Sources for ``<folder>/<name><suffix>``, as the Parquet sink lays tables out."""
    return {name: Source(f"{folder}/{name}{suffix}") for name in names}


def open_table(spark: SparkSession, source: Source, *, bad_lines: str | None = None) -> DataFrame:
    """Open one table lazily.

    A value that does not fit its declared type is read as null.  ``bad_lines`` names a column
    that then keeps the text of every such line.
    """
    reader = spark.read.format(source.format)
    schema = source.schema
    if bad_lines:
        reader = reader.option("columnNameOfCorruptRecord", bad_lines)
        schema = f"{schema}, `{bad_lines}` string" if schema else None
    if schema:
        reader = reader.schema(schema)
    return reader.load(source.path)


def open_tables(spark: SparkSession, sources: Mapping[str, Source]) -> dict[str, DataFrame]:
    """Open every table whose files exist; warn about the others and go on."""
    found = {}
    for name, source in sources.items():
        try:
            found[name] = open_table(spark, source)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"table '{name}' skipped: nothing at {source.path}", UserWarning, stacklevel=2)
    return found


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and a watch that counts its rows during the first action on it."""
    seen = Observation()
    return df.observe(seen, rows().alias("rows")), seen


def counted(seen: Observation) -> int:
    """What the watch counted.  Spark does not even run a frame it knows to be empty."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as nothing:
        if "AssertionError" not in str(nothing):
            raise
        return 0


@contextmanager
def held(frames: Mapping[str, DataFrame], columns: Mapping[str, Iterable[str]] | None = None) -> Iterator[dict[str, DataFrame]]:
    """Keep frames for the length of a ``with`` block, reduced to the columns it will use."""
    kept = {}
    for name, df in frames.items():
        wanted = columns.get(name) if columns else None
        kept[name] = (df.select(*present(df, wanted)) if wanted else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        for df in kept.values():
            df.unpersist()
