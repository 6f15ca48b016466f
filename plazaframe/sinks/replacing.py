"""Replacing stored tables without a moment in which there is none (K2).

A whole table is written aside, under a version of its own, and becomes the table when a small manifest that names it is
renamed into place; a reader takes the newest manifest. A writer that fails leaves no manifest, so the version before stays the table. Of
a partitioned table only the partitions that come with the new rows are replaced; the others keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plazaframe.sources.tables import counted, observed

_MANIFESTS, _VERSIONS = "manifests", "versions"


class Folder:
    """A folder in any file system that Spark reads, with the few calls a manifest needs."""

    def __init__(self, spark: SparkSession, path: str):
        jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        self.system = self.at(".").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.at(folder)):
            return []
        return sorted(f.getPath().getName() for f in self.system.listStatus(self.at(folder)))

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> bool:
        """Write a small file under another name and rename it; False if the name was taken meanwhile."""
        aside = f"{name}.{uuid.uuid4().hex}.writing"
        stream = self.system.create(self.at(aside), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not self.system.exists(self.at(name)) and self.system.rename(self.at(aside), self.at(name)):
            return True
        self.system.delete(self.at(aside), False)
        return False

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)


def _manifests(folder: Folder) -> list[str]:
    return [n for n in folder.names(_MANIFESTS) if n.endswith(".json")]


def replace_table(df: DataFrame, path: str, *, keep: int = 2) -> int:
    """Make ``df`` the table at ``path``; returns its rows. ``df`` may read the table it replaces.

    ``keep`` versions stay, this one included, so that readers of the one before can end. If another writer was faster an error is raised, and
    its table stays.
    """
    folder = Folder(df.sparkSession, path)
    known = _manifests(folder)
    number = int(known[-1].split(".")[0]) + 1 if known else 1
    version = f"{_VERSIONS}/{number:08}-{uuid.uuid4().hex}"
    watched, seen = observed(df)
    watched.write.parquet(f"{folder.path}/{version}")
    told = {"version": version, "rows": counted(seen), "schema": df.schema.json()}
    if not folder.write_once(f"{_MANIFESTS}/{number:08}.json", json.dumps(told)):
        folder.delete(version)
        raise RuntimeError(f"{path} was replaced by another writer meanwhile")
    for old in _manifests(folder)[:-keep]:
        gone = json.loads(folder.read(f"{_MANIFESTS}/{old}"))["version"]
        folder.delete(f"{_MANIFESTS}/{old}")
        folder.delete(gone)
    return told["rows"]


def open_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as its newest manifest has it."""
    folder = Folder(spark, path)
    known = _manifests(folder)
    if not known:
        raise FileNotFoundError(f"no table at {path}")
    told = json.loads(folder.read(f"{_MANIFESTS}/{known[-1]}"))
    return spark.read.schema(StructType.fromJson(json.loads(told["schema"]))).parquet(f"{folder.path}/{told['version']}")


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions of a stored table that ``df`` has rows for; all other partitions keep their files.

    Tasks write aside and the files change places when all have ended, so a failing rewrite leaves the table as it was. Rows of one partition come
    together first, many partitions to a task, and a large partition is split.
    """
    df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
