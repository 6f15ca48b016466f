"""Writing an intermediate table once, so that several passes can read it.

The table goes to the folder the cluster names in ``spark.checkpoint.dir``, unless the session names
one of its own in ``plazaframe.scratch.dir`` (a ``scratch`` block does), and comes back as a
plain Parquet scan: it outlives executors, later passes read only the columns they need, and
Catalyst knows its real size, so it is broadcast only when it is under the session's threshold.

There is no default folder: without a setting an error is raised. What was written stays until ``drop_materialised``
or the end of a ``scratch`` block deletes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLUSTER, SETTING = "spark.checkpoint.dir", "plazaframe.scratch.dir"


def named_folder(spark: SparkSession) -> str | None:
    """The folder that a setting names."""
    return spark.conf.get(SETTING, None) or spark.conf.get(CLUSTER, None) or spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    root = named_folder(spark)
    if not root:
        raise RuntimeError(f"set {CLUSTER} to a folder that all executors share")
    return f"{root.rstrip('/')}/plazaframe-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """A path of its own for one intermediate table."""
    return f"{scratch_folder(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` and return a scan of what was written."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the one table that ``materialise`` returned; frames that still read it become unusable."""
    spark = df.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    jvm = spark.sparkContext._jvm
    for folder in folders:
        if f"/plazaframe-{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"{folder} is not a table of this application")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself if every evaluation gives the same rows, else what one evaluation gave.

    Operators that read their input more than once would otherwise join the rows of different draws.
    """
    return df if df._jdf.queryExecution().analyzed().deterministic() else materialise(df)


def is_scan(df: DataFrame) -> bool:
    """Whether reading ``df`` again costs one scan: columns and rows chosen from a single stored table, nothing else."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.children().isEmpty()


def drop_materialised(spark: SparkSession) -> None:
    """Delete what this application materialised; frames built on it become unusable."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, folder: str) -> Iterator[None]:
    """Intermediate tables go below ``folder`` within the block, and are deleted at its end."""
    before = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, folder)
    try:
        yield
    finally:
        drop_materialised(spark)
        if before is None:
            spark.conf.unset(SETTING)
        else:
            spark.conf.set(SETTING, before)
