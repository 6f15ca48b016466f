"""Constant columns, scaling and binning from one pass of measurements."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaframe.functions.columns import comparable_sql, numeric_columns, quoted
from plazaframe.schemas import IDENTIFIERS

# Numbers that are codes or calendar parts, never scaled.
UNSCALED = [*IDENTIFIERS, "is_open", "is_elite"]
UNSCALED_ENDINGS = ["_year", "_month", "_day_of_week"]


@dataclass(frozen=True)
class Measures:
    """Row count of a table, its constant columns, and low/high/mean/spread of its numbers."""

    rows: int
    constant: list[str]
    low: dict[str, Any]
    high: dict[str, Any]
    mean: dict[str, float]
    spread: dict[str, float]


def measure(
    df: DataFrame, *, screened: Iterable[str] = (), ranged: Iterable[str] = (), spread: Iterable[str] = ()
) -> Measures:
    """One pass: which ``screened`` columns hold at most one value besides null, the range of the
    ``ranged`` ones, and mean and sample standard deviation of the ``spread`` ones.

    A column is constant exactly when its least and greatest values are equal (or both null);
    that needs no distinct count, so nothing is shuffled but one row per task.
    """
    screened, ranged, spread = list(screened), list(ranged), list(spread)
    sought = {"_rows": "count(1)"}
    sought |= {f"same_{c}": "min({0}) <=> max({0})".format(comparable_sql(df, c)) for c in screened}
    sought |= {f"{end}_{c}": f"{take}({quoted(c)})" for c in ranged for end, take in (("low", "min"), ("high", "max"))}
    sought |= {f"{m}_{c}": f"CAST({take}({quoted(c)}) AS DOUBLE)" for c in spread for m, take in (("mean", "avg"), ("sd", "stddev"))}
    row = df.selectExpr(*(f"{sql} AS {quoted(name)}" for name, sql in sought.items())).first()
    return Measures(
        rows=row["_rows"],
        constant=sorted(c for c in screened if row[f"same_{c}"]),
        low={c: row[f"low_{c}"] for c in ranged},
        high={c: row[f"high_{c}"] for c in ranged},
        mean={c: row[f"mean_{c}"] for c in spread},
        spread={c: row[f"sd_{c}"] for c in spread},
    )


def screenable(df: DataFrame, keep: Iterable[str] = ()) -> list[str]:
    """Columns the screen may drop: all but identifiers and those to ``keep``."""
    safe = {*IDENTIFIERS, *keep}
    return [c for c in df.columns if c not in safe]


def constant_columns(df: DataFrame, keep: Iterable[str] = ()) -> list[str]:
    """Columns with one value or none, sorted.  A table below two rows has no say in this."""
    found = measure(df, screened=screenable(df, keep))
    return found.constant if found.rows > 1 else []


def scalable(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return numeric_columns(df, without=[*UNSCALED, *exclude], not_ending=UNSCALED_ENDINGS)


def _scaled(value: Column, origin: float | None, unit: float | None) -> Column | None:
    """(value - origin) / unit; 0 for a zero unit, nothing to do where either is unknown."""
    if origin is None or unit is None:
        return None
    if unit == 0:
        return F.lit(0.0)
    return (value.cast("double") - F.lit(float(origin))) / F.lit(float(unit))


def rescale(df: DataFrame, columns: Sequence[str], method: str, found: Measures) -> DataFrame:
    """Scale columns in place, from measurements already taken."""
    if method == "minmax":
        units = {c: None if found.low[c] is None else found.high[c] - found.low[c] for c in columns}
        new = {c: _scaled(F.col(c), found.low[c], units[c]) for c in columns}
    else:
        new = {c: _scaled(F.col(c), found.mean[c], found.spread[c]) for c in columns}
    return df.withColumns({c: e for c, e in new.items() if e is not None})


def measured_for(method: str, columns: Sequence[str]) -> dict[str, Sequence[str]]:
    """The measurements a scaling method asks for, as arguments of ``measure``."""
    wanted = {"minmax": {"ranged": columns}, "standard": {"spread": columns}, "none": {}}
    if method not in wanted:
        raise ValueError(f"unknown scaling: {method!r}")
    return wanted[method]


def scale(df: DataFrame, method: str = "minmax", exclude: Iterable[str] = ()) -> DataFrame:
    """Scale numbers to [0, 1] ("minmax") or to mean 0 and sample deviation 1 ("standard").

    One aggregate serves all columns.  A column without spread becomes 0.0, an all-null one is
    left alone.  Columns keep their places.
    """
    columns = scalable(df, exclude)
    if method == "none" or not columns:
        return df
    return rescale(df, columns, method, measure(df, **measured_for(method, columns)))


def with_bins(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add ``<column>_bin``: the number of the interval [edge i, edge i+1) a value falls into.

    The last interval includes its upper edge; values outside all intervals get null.
    """
    new = {}
    for column, bounds in edges.items():
        value, (lowest, *inner, highest) = F.col(column), sorted(bounds)
        index = sum((F.when(value >= e, 1).otherwise(0) for e in inner), start=F.lit(0))
        new[f"{column}_bin"] = F.when(value.between(lowest, highest), index)
    return df.withColumns(new)
