"""Queries over awkward data, on values that the sample tables do not reach."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from plazaframe.operators import aggregate


def test_means_of_keys_that_fit_no_long(spark, tmp_path):
    rows = [(8_999_999, "1-URGENT"), (9_000_000, "1-URGENT"), (4, "5-LOW")]
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    found = entry_points.queries()["mean_of_large_keys"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in found} == {("1-URGENT", 8_999_999.5e13), ("5-LOW", 4e13)}


def test_means_of_longs_and_decimals_whose_sum_fits_no_long(spark):
    for kind, large in (("long", 2**63 - 1), ("decimal(34,0)", Decimal(10**32))):
        keys = spark.createDataFrame([(large,)] * 3, f"key {kind}").select(F.lit(1).alias("g"), "key")
        assert aggregate.group_stats(keys, ["g"], means={"mean": "key"}).first().mean == float(large)
