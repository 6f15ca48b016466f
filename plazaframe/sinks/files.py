"""CSV results, Parquet tables and bounded samples (K1-K3, K5)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable, present
from plazaframe.sources.tables import counted, observed


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> str:
    """Write a result with a header row, replacing what was there.

    A result cut by a limit is one partition and so one file anyway.  ``single_file`` sends
    any other result through one task: for small ones only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)
    return path


def write_tables(
    frames: Mapping[str, DataFrame],
    folder: str,
    *,
    num_partitions: int | None = None,
    partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write each table to ``<folder>/<name>`` as Parquet; returns the rows written per table.

    Files are levelled by adaptive execution unless a number of partitions is given.  The rows
    are counted while they are written.
    """
    written = {}
    for name, df in frames.items():
        watched, seen = observed(df)
        keys = present(df, partition_by)
        # Rows of one folder come together, so that a folder does not get a file from every task.
        spread = watched.repartition(num_partitions) if num_partitions else watched.hint("rebalance", *keys)
        writer = spread.write.mode("overwrite")
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{folder}/{name}")
        written[name] = counted(seen)
    return written


def bounded_sample(
    df: DataFrame, fraction: float = 0.15, seed: int = 42, max_rows: int | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """A random sample of the wanted columns, for a plot or a look.

    Only those columns are read.  Fails if the frame has none of them.  With ``max_rows`` the
    sample has at most that many rows, those with the least hash of seed and row, wherever they
    lie in the table; each task keeps no more than that.
    """
    if columns is not None:
        wanted = list(columns)
        kept = present(df, wanted)
        if not kept:
            raise ValueError(f"the frame has none of the columns {wanted}")
        df = df.select(*kept)
    drawn = df.sample(False, fraction, seed)
    if max_rows is None:
        return drawn
    return drawn.orderBy(F.xxhash64(F.lit(seed), *[comparable(drawn, c) for c in drawn.columns])).limit(max_rows)
