"""Preparing tables stage by stage.

Stages: clean, flatten, prune, screen, transform, reduce.  What a stage has to know of the data
(fills, constant columns, ranges) is measured in one pass over all columns, and the row counts of
the audit come out of the same passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from plazaframe.functions.columns import numeric_columns
from plazaframe.functions.dates import DATE_COLUMNS, with_date_parts
from plazaframe.operators import scaling
from plazaframe.operators.cleaning import complete_rows, deduplicate, fill_missing, fill_values, without_null_keys
from plazaframe.operators.durable import materialise
from plazaframe.operators.flattening import flatten
from plazaframe.operators.reducing import principal_components, sample_rows
from plazaframe.schemas import KEYS
from plazaframe.sources.quarantine import open_available
from plazaframe.sources.tables import Source, open_tables

STAGES = ["clean", "flatten", "prune", "screen", "transform", "reduce"]
AUDIT = "table string, position int, stage string, rows long, columns int, added array<string>, dropped array<string>"


@dataclass(frozen=True)
class Settings:
    """How one table is prepared."""

    keys: Sequence[str] = ()
    nulls: str = "impute"  # or "drop": drop every row with a null
    fill_numbers: str = "median"  # or "mean"
    fill_text: str = "Unknown"
    fill_exclude: Sequence[str] = ()
    median_error: float | None = None  # None: exact
    remove_duplicates: bool = True
    prune: Sequence[str] = ()  # dropped once flattened
    screen: bool = True
    screen_keep: Sequence[str] = ()
    dates: Sequence[str] = tuple(DATE_COLUMNS)  # () parses none
    scaling: str = "minmax"  # or "standard" or "none"
    scale_exclude: Sequence[str] = ()
    drop: Sequence[str] = ()  # dropped once dates are parsed
    bins: Mapping[str, Sequence[float]] = field(default_factory=dict)
    sample_fraction: float | None = None
    sample_seed: int = 42
    components: int | None = None  # principal components of the scaled numbers


def default_settings() -> dict[str, Settings]:
    """What each of the six tables drops, and when."""
    prune = {"business": ["attributes", "hours", "categories"], "user": ["friends", "elite"]}
    drop = {"review": ["date"], "checkin": ["date"], "tip": ["date"]}
    return {t: Settings(keys=keys, prune=prune.get(t, []), drop=drop.get(t, [])) for t, keys in KEYS.items()}


def settings_for(table: str, given: Mapping[str, Settings] | None) -> Settings:
    return (given or {}).get(table) or default_settings().get(table) or Settings()


@dataclass(frozen=True)
class Step:
    """One line of the audit: a table after a stage.  ``rows`` is None where nothing was counted."""

    table: str
    stage: str
    rows: int | None
    before: Sequence[str]
    after: Sequence[str]

    def record(self) -> tuple:
        added = [c for c in self.after if c not in self.before]
        dropped = [c for c in self.before if c not in self.after]
        position = ["load", *STAGES].index(self.stage)
        return (self.table, position, self.stage, self.rows, len(self.after), added, dropped)


@dataclass(frozen=True)
class Prepared:
    """A prepared table and the audit of its stages."""

    frame: DataFrame
    steps: list[Step]

    @property
    def dropped_constant(self) -> list[str]:
        return sorted(c for s in self.steps if s.stage == "screen" for c in s.before if c not in s.after)


def clean(df: DataFrame, settings: Settings) -> tuple[DataFrame, int | None]:
    """Rows without a key go, other nulls are filled (or their rows go too), then duplicates.

    Fills are measured before duplicates go, so duplicates weigh in.  Also returned is the number
    of rows there were, if the filling measured it.
    """
    filled, loaded = without_null_keys(df, settings.keys), None
    if settings.nulls == "drop":
        filled = complete_rows(filled)
    else:
        leave = [*settings.keys, *settings.fill_exclude]
        columns = numeric_columns(df, without=leave)
        numbers, loaded = fill_values(df, columns, settings.fill_numbers, settings.median_error, keys=settings.keys)
        filled = fill_missing(filled, numbers, settings.fill_text, leave=leave)
    return (deduplicate(filled, settings.keys) if settings.remove_duplicates else filled), loaded


def screen(df: DataFrame, settings: Settings) -> tuple[DataFrame, list[str]]:
    """Drop the columns with one value or none; also which those are."""
    dull = scaling.constant_columns(df, settings.screen_keep) if settings.screen else []
    return df.drop(*dull), dull


def transform(df: DataFrame, settings: Settings, found: scaling.Measures | None = None) -> DataFrame:
    """Date parts, scaling (from ``found`` if already measured), bins, then the drops.

    Bins are cut on the values before scaling.
    """
    binned = scaling.with_bins(with_date_parts(df, settings.dates), settings.bins)
    own_bins = [f"{c}_bin" for c in settings.bins]
    exclude = [*settings.scale_exclude, *own_bins]
    if found is None:
        scaled = scaling.scale(binned, settings.scaling, exclude)
    else:
        columns = [c for c in scaling.scalable(binned, exclude) if c in found.low or c in found.mean]
        scaled = scaling.rescale(binned, columns, settings.scaling, found) if columns else binned
    return scaled.drop(*settings.drop)


def reduce_rows(df: DataFrame, settings: Settings) -> DataFrame:
    """Sampling, and principal components of the scaled numbers if asked for."""
    sampled = sample_rows(df, settings.sample_fraction, settings.sample_seed)
    if not settings.components:
        return sampled
    skip = [*settings.scale_exclude, *(f"{c}_bin" for c in settings.bins)]
    return principal_components(sampled, scaling.scalable(sampled, skip), settings.components)


def prepare(df: DataFrame, table: str, settings: Settings | None = None, *, write_cleaned: bool = True) -> Prepared:
    """All stages for one table, with two measuring passes.

    The first pass finds the fills.  The cleaned and flattened rows are written once
    (``write_cleaned``; without it they are computed twice); the second pass reads the columns
    it needs from there and serves the screen and the scaling together.
    """
    given = settings or settings_for(table, None)
    cleaned, loaded = clean(df, given)
    flat = flatten(cleaned, table, given.fill_text)
    pruned = flat.drop(*given.prune)
    if write_cleaned:
        pruned = materialise(pruned)
    found = _measured(pruned, given)
    screened = pruned.drop(*found.constant) if found.rows > 1 else pruned
    transformed = transform(screened, given, found)
    reduced = reduce_rows(transformed, given)
    whole = given.sample_fraction is None or given.sample_fraction >= 1.0
    names = [df.columns, cleaned.columns, flat.columns, pruned.columns, screened.columns, transformed.columns, reduced.columns]
    counts = [loaded, found.rows, found.rows, found.rows, found.rows, found.rows, found.rows if whole else None]
    stages = ["load", *STAGES]
    steps = [Step(table, s, n, before, after) for s, n, before, after in zip(stages, counts, [names[0], *names], names)]
    return Prepared(reduced, steps)


def prepare_all(
    spark: SparkSession,
    sources: Mapping[str, Source],
    settings: Mapping[str, Settings] | None = None,
    *,
    write_cleaned: bool = True,
    bad_folder: str | None = None,
) -> dict[str, Prepared]:
    """Open and prepare every available table; with ``bad_folder`` without the bad lines of declared tables, which go there."""
    frames = open_available(spark, sources, bad_folder)
    return {t: prepare(df, t, settings_for(t, settings), write_cleaned=write_cleaned) for t, df in frames.items()}


def run_stage(
    stage: str,
    frames: Mapping[str, DataFrame],
    settings: Mapping[str, Settings] | None = None,
    *,
    write: bool = False,
) -> dict[str, DataFrame]:
    """One stage for all tables, for callers who want to look at the tables in between.

    With ``write`` each table is written down after the stage, so that later stages and their
    measuring passes do not compute it again.
    """
    work = {
        "clean": lambda df, t, s: clean(df, s)[0],
        "flatten": lambda df, t, s: flatten(df, t, s.fill_text),
        "prune": lambda df, t, s: df.drop(*s.prune),
        "screen": lambda df, t, s: screen(df, s)[0],
        "transform": lambda df, t, s: transform(df, s),
        "reduce": lambda df, t, s: reduce_rows(df, s),
    }[stage]
    done = {t: work(df, t, settings_for(t, settings)) for t, df in frames.items()}
    return {t: materialise(df) for t, df in done.items()} if write else done


def staged(
    frames: Mapping[str, DataFrame], settings: Mapping[str, Settings] | None = None, *, write: Sequence[str] = ("clean",)
) -> Iterator[tuple[str, dict[str, DataFrame]]]:
    """Every stage in turn with all tables as they are after it, for callers who want to look at them in between.

    The same as ``run_stage`` for one stage after the other, but the screen measures each table once for itself and
    for the scaling. Tables are written down after the stages in ``write``.
    """
    given = {t: settings_for(t, settings) for t in frames}
    now, found = dict(frames), {}
    for stage in STAGES:
        if stage == "screen":
            for t, df in now.items():
                found[t] = _measured(df, given[t])
            now = {t: df.drop(*found[t].constant) if found[t].rows > 1 else df for t, df in now.items()}
        elif stage == "transform":
            now = {t: transform(df, given[t], found[t]) for t, df in now.items()}
        else:
            now = run_stage(stage, now, settings)
        if stage in write:
            now = {t: materialise(df) for t, df in now.items()}
        yield stage, dict(now)


def _measured(df: DataFrame, given: Settings) -> scaling.Measures:
    """What the screen and the scaling have to know, in one pass."""
    columns = scaling.scalable(df, given.scale_exclude)
    screened = scaling.screenable(df, given.screen_keep) if given.screen else []
    return scaling.measure(df, screened=screened, **scaling.measured_for(given.scaling, columns))


def audit_table(spark: SparkSession, prepared: Mapping[str, Prepared]) -> DataFrame:
    """One row per table and stage: rows, columns, and which columns came and went."""
    return spark.createDataFrame([s.record() for p in prepared.values() for s in p.steps], AUDIT)


def with_final_counts(prepared: Mapping[str, Prepared], written: Mapping[str, int]) -> dict[str, Prepared]:
    """Fill in the last stage's row counts, as the sink counted them while writing."""

    def done(p: Prepared, n: int | None) -> Prepared:
        return replace(p, steps=[*p.steps[:-1], replace(p.steps[-1], rows=n if n is not None else p.steps[-1].rows)])

    return {t: done(p, written.get(t)) for t, p in prepared.items()}


def write_audit(spark: SparkSession, prepared: Mapping[str, Prepared], path: str) -> None:
    audit_table(spark, prepared).coalesce(1).write.mode("overwrite").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame | None:
    """The audit written earlier; None if there is none."""
    return open_tables(spark, {"audit": Source(path)}).get("audit")
