"""Preparing tables so that a restart goes on behind the last stage that was finished.

Stages that are worth keeping are written to a folder named after the table, the stage and a digest of the input
files, the settings and the stages before. The manifest of a stage is written last. A restart reads a stage with a manifest and works on
from there; changed inputs or settings give other digests, so nothing stale is read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazaframe.functions.measures import rows
from plazaframe.plans import preparation
from plazaframe.plans.preparation import STAGES, Settings, settings_for
from plazaframe.sinks.replacing import Folder
from plazaframe.sources.quarantine import open_available
from plazaframe.sources.tables import Source, counted, observed

KEPT = ("clean", "screen", "transform")


def snapshot(spark: SparkSession, source: Source) -> str:
    """A digest of a source's files: their names, sizes and times; the listing is Spark's, and no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source.path).select("path", "length", "modificationTime")
    found = files.agg(rows().alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("d")).first()
    return f"{found['n']}:{found['d']}:{source.format}:{source.schema}"


def _digest(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:24]


def prepare_resumable(
    spark: SparkSession,
    sources: Mapping[str, Source],
    folder: str,
    settings: Mapping[str, Settings] | None = None,
    *,
    kept: Sequence[str] = KEPT,
    bad_folder: str | None = None,
) -> dict[str, DataFrame]:
    """Every available table after all stages; stages in ``kept`` are written below ``folder`` and found there by a restart.

    The frames equal those of ``prepare_all``. The cleaning must be among the kept stages for a restart to skip it.
    """
    done = {}
    for table, df in open_available(spark, sources, bad_folder).items():
        given = settings_for(table, settings)
        print_of_input = snapshot(spark, sources[table])
        names = {s: f"{table}/{s}-{_digest(print_of_input, sorted(vars(given).items(), key=str), STAGES[: i + 1], kept)}" for i, s in enumerate(STAGES)}
        done[table] = _run(spark, df, table, given, Folder(spark, folder), {s: n for s, n in names.items() if s in kept})
    return done


def _run(spark: SparkSession, df: DataFrame, table: str, given: Settings, folder: Folder, names: Mapping[str, str]) -> DataFrame:
    finished = [s for s in STAGES if s in names and folder.names(names[s] + "/manifest")]
    now = df
    for stage in STAGES[STAGES.index(finished[-1]) :] if finished else STAGES:
        if finished and stage == finished[-1]:
            now = _stored(spark, folder, names[stage])
            continue
        now = preparation.run_stage(stage, {table: now}, {table: given})[table]
        if stage in names:
            watched, seen = observed(now)
            watched.write.mode("overwrite").parquet(f"{folder.path}/{names[stage]}/rows")
            told = {"rows": counted(seen), "schema": now.schema.json()}
            folder.write_once(f"{names[stage]}/manifest/stage.json", json.dumps(told))
            now = _stored(spark, folder, names[stage])
    return now


def _stored(spark: SparkSession, folder: Folder, name: str) -> DataFrame:
    told = json.loads(folder.read(f"{name}/manifest/stage.json"))
    return spark.read.schema(StructType.fromJson(json.loads(told["schema"]))).parquet(f"{folder.path}/{name}/rows")
