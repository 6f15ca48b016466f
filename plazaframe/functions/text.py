"""Expressions over text and delimited lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from plazaframe.functions.columns import literal, quoted


def filled(column: str) -> Column:
    """Neither null nor the empty string."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def mentions(column: str, part: str) -> Column:
    """Case-sensitive substring test: 'Food' is found in 'Fast Food'."""
    return F.col(column).contains(part)


def lists_token(column: str, token: str) -> Column:
    """Exact member test on a comma-separated list: 'Food' is not found in 'Fast Food'."""
    return F.array_contains(F.split(F.trim(column), r"\s*,\s*"), token)


def entry_count(column: str) -> Column:
    """Entries of a comma-separated list, empty ones included; null and blank text have none.

    Counts separators, so no array is built for a long list.
    """
    text = F.col(column)
    commas = F.length(text) - F.length(F.replace(text, F.lit(",")))
    return F.when(F.trim(text) != "", commas + 1).otherwise(0)


def token_count(column: str, placeholders: Iterable[str] = ("none", "unknown")) -> Column:
    """Entries of a comma-separated list that say something.

    Blank entries do not count, nor do (in any case) the placeholder words.
    """
    words = [w.lower() for w in placeholders]
    tokens = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda t: F.trim(t))
    kept = F.filter(tokens, lambda t: (t != "") & ~F.lower(t).isin(words) if words else t != "")
    return F.size(kept)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0)


def map_size(column: str) -> Column:
    """Number of keys of a map; a null map has none."""
    return F.coalesce(F.size(F.map_keys(column)), F.lit(0))


def map_values(column: str, names: Mapping[str, str]) -> dict[str, Column]:
    """New column name -> text value of a map key; null where the key is absent."""
    return {new: F.expr(f"CAST({quoted(column)}[{literal(key)}] AS STRING)") for key, new in names.items()}
