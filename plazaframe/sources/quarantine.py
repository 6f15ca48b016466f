"""Reading declared tables line by line, with bad lines set aside."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaframe.functions.columns import quoted
from plazaframe.functions.measures import rows
from plazaframe.operators.durable import materialise
from plazaframe.sources.tables import Source, open_table, open_tables

_LINE, _FILE = "_bad_line", "_source_file"
REPORT = "table string, file string, rows long, bad long"


@dataclass(frozen=True)
class Separated:
    """A table without its bad lines, those lines (file, line), and per file how many rows it gave and how many were bad."""

    good: DataFrame
    bad: DataFrame
    files: DataFrame


def separate(spark: SparkSession, source: Source, *, bad_folder: str | None = None) -> Separated:
    """Read a declared JSON or CSV table once, and set the lines that do not fit its schema aside.

    A line is bad if it cannot be parsed, or if one of its values does not fit the declared type. The parsed rows are written to the shared
    folder, with the text of bad lines beside them, so that good rows, bad lines and counts come from a single parsing. With ``bad_folder`` the bad
    lines are also kept there, as JSON lines of file and line, which is replaced.
    """
    if not source.schema:
        raise ValueError(f"{source.path} needs a declared schema")
    opened = open_table(spark, source, bad_lines=_LINE)
    parsed = materialise(opened.withColumn(_FILE, F.col("_metadata.file_path")))
    is_bad = F.col(_LINE).isNotNull()
    bad = parsed.where(is_bad).select(F.col(_FILE).alias("file"), F.col(_LINE).alias("line"))
    if bad_folder:
        bad.write.mode("overwrite").json(bad_folder)
        bad = spark.read.schema("file string, line string").json(bad_folder)
    files = parsed.groupBy(F.col(_FILE).alias("file")).agg(F.count_if(~is_bad).alias("rows"), F.count_if(is_bad).alias("bad"))
    good = parsed.where(~is_bad).select(*(F.expr(quoted(c)) for c in parsed.columns if c not in (_LINE, _FILE)))
    return Separated(good, bad, files)


def open_separated(spark: SparkSession, sources: Mapping[str, Source], bad_folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table that is there without its bad lines, and the report of all files: table, file, rows, bad.

    Bad lines go to ``<bad_folder>/<table>``. Tables without a declared schema (Parquet, say) are opened as they are and have no lines in the
    report; tables without files are skipped with a warning, as ``open_tables`` does.
    """
    frames = open_tables(spark, sources)
    report = spark.createDataFrame([], REPORT)
    for name in list(frames):
        if sources[name].schema and sources[name].format in ("json", "csv"):
            parted = separate(spark, sources[name], bad_folder=f"{bad_folder}/{name}")
            frames[name] = parted.good
            report = report.unionByName(parted.files.select(F.lit(name).alias("table"), "file", "rows", "bad"))
    return frames, report


def open_available(spark: SparkSession, sources: Mapping[str, Source], bad_folder: str | None = None) -> dict[str, DataFrame]:
    """Every table that is there; with ``bad_folder`` bad lines are set aside, and the report of all files is written to ``<bad_folder>/report``."""
    if bad_folder is None:
        return open_tables(spark, sources)
    frames, report = open_separated(spark, sources, bad_folder)
    report.write.mode("overwrite").parquet(f"{bad_folder}/report")
    return frames


def bad_share(report: DataFrame) -> DataFrame:
    """Per table its rows, bad lines, files, files with bad lines, and the share of bad lines; a status line for a load."""
    per_table = report.groupBy("table").agg(
        F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), rows().alias("files"), F.count_if(F.col("bad") > 0).alias("files_with_bad")
    )
    return per_table.withColumn("bad_share", F.try_divide("bad", F.col("rows") + F.col("bad")))
