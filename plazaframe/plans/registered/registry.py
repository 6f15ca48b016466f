"""The register: query name -> function of (session, folder), and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plazaframe.plans.sample_tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the sample tables under ``name``."""

    def register(run: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: run(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return run

    return register
