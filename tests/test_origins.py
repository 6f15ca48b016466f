"""Where prepared columns come from."""

import pytest
from pyspark.sql import types as T

from plazaframe.plans import origins, preparation
from plazaframe.schemas import SCHEMAS


def schema(spark, table):
    return spark.createDataFrame([], SCHEMAS[table]).schema


def test_places_and_their_attributes(spark):
    found = origins.edges(spark, schema(spark, "business"), "business")
    roots = origins.origins(found)
    assert roots["attr_WiFi"] == ["attributes"] and roots["hours_mon"] == ["hours"] and roots["open_days_count"] == ["hours"]
    assert roots["category_count"] == ["categories"] and roots["stars"] == ["stars"] and roots["name"] == ["name"]
    assert "attributes" not in roots and ("business", "flatten", "attributes", ["attributes"]) in found


def test_dates_bins_and_components(spark):
    settings = preparation.Settings(keys=["review_id"], drop=["date"], bins={"stars": [0.0, 2.0, 5.0]}, components=2, scale_exclude=["review_id"])
    roots = origins.origins(origins.edges(spark, schema(spark, "review"), "review", settings))
    assert all(roots[f"date_{part}"] == ["date"] for part in ("parsed", "year", "month", "day_of_week"))
    assert roots["stars_bin"] == ["stars"] and roots["useful"] == ["useful"]
    assert set(roots["components"]) >= {"stars", "useful", "funny", "cool"} and "text" not in roots["components"]
    assert "date" not in roots


@pytest.mark.parametrize("table", ["user", "checkin", "tip"])
def test_every_prepared_column_has_an_origin(spark, table):
    told = origins.edge_table(spark, {table: schema(spark, table)}).collect()
    roots = origins.origins([tuple(r) for r in told])
    assert roots and all(sources and set(sources) <= set(schema(spark, table).names) for sources in roots.values())
    frame = spark.createDataFrame([], schema(spark, table))
    assert set(preparation.prepare(frame, table).frame.columns) == set(roots)


def test_a_table_without_columns(spark):
    assert origins.origins(origins.edges(spark, T.StructType([]), "photo")) == {}
