"""The sample tables in the roles of places, reviews, users, tips, photos and check-ins.

Each role is a projection of the given tables, so the questions run on them unchanged.  Prices
become decimals where they are summed, which makes sums independent of their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaframe.functions.text import flag
from plazaframe.sources.tables import Source, open_table

MONEY = "decimal(18,2)"


# The declared schemas of the sample tables, so that no file is opened to infer one.
SAMPLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Opens the Parquet tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SAMPLE_SCHEMAS:
            raise AttributeError(name)
        return open_table(self.spark, Source(f"{self.folder}/{name}.parquet", schema=SAMPLE_SCHEMAS[name]))


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def day_text(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def second_text(column: str) -> Column:
    return F.substring(F.col(column).cast("string"), 1, 19)


def roles(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Select columns under new names: ``roles(df, city="n_name")``."""
    return df.select(*((F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()))


def supplier_places(t: Tables) -> DataFrame:
    """Suppliers as places: the nation is the city and the region the state."""
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return roles(placed, business_id="s_suppkey", name="s_name", city="n_name", state="r_name", stars=money("s_acctbal"))


def customer_places(t: Tables) -> DataFrame:
    """Customers as places, open unless they are builders."""
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return roles(
        placed,
        business_id="c_custkey",
        name="c_name",
        city="n_name",
        state="c_mktsegment",
        stars="c_acctbal",
        review_count="c_nationkey",
        is_open=flag(F.col("c_mktsegment") != "BUILDING"),
    )


def order_places(t: Tables) -> DataFrame:
    """Orders with their customer as places: the segment is the state and the price the reviews."""
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return roles(
        placed,
        business_id="o_orderkey",
        name="c_name",
        city="o_orderpriority",
        state="c_mktsegment",
        stars="c_acctbal",
        review_count="o_totalprice",
        is_open=flag(F.col("o_orderstatus") != "P"),
    )


def part_places(t: Tables) -> DataFrame:
    """Parts as places: the words of the name are the categories."""
    return roles(
        t.part,
        business_id="p_partkey",
        name="p_name",
        city="p_brand",
        state="p_type",
        stars="p_retailprice",
        review_count="p_size",
        is_open=flag(F.col("p_type") != "ECONOMY"),
        categories=F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
    )


def line_reviews(t: Tables, place: str = "l_suppkey") -> DataFrame:
    """Order lines as reviews of a supplier (or part), with the quantity as stars."""
    return roles(
        t.lineitem,
        review_id="l_orderkey",
        user_id="l_partkey",
        business_id=place,
        stars=F.col("l_quantity").cast(MONEY),
        useful="l_extendedprice",
        funny="l_discount",
        cool="l_tax",
        date=day_text("l_shipdate"),
    )


def order_users(t: Tables) -> DataFrame:
    """Orders as users who joined on the order date."""
    return roles(
        t.orders,
        user_id="o_orderkey",
        name="o_orderpriority",
        yelping_since=day_text("o_orderdate"),
        review_count="o_custkey",
        fans="o_orderkey",
        average_stars=money("o_totalprice"),
        useful=money("o_totalprice"),
    )


def event_tips(t: Tables) -> DataFrame:
    """Events as tips: by a user, about the customer of the same number, with props as the text."""
    return roles(
        t.events,
        user_id="user_id",
        business_id="user_id",
        text="props",
        compliment_count=money("value"),
        date=second_text("ts"),
    )


def gappy_lines(t: Tables) -> DataFrame:
    """Order lines with some values taken out; the SQL beside takes out the same ones."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.nullif("l_suppkey", F.lit(3)).alias("l_suppkey"),
    )


GAPPY_LINES = """(SELECT l_orderkey, l_linenumber, nullif(l_quantity, 7) AS l_quantity,
                    nullif(l_returnflag, 'R') AS l_returnflag, nullif(l_suppkey, 3) AS l_suppkey FROM lineitem)"""


def gappy_parts(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.nullif("p_size", F.lit(3)).alias("p_size"),
        F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        "p_retailprice",
    )


GAPPY_PARTS = """(SELECT p_partkey, nullif(p_size, 3) AS p_size, nullif(p_type, 'PROMO') AS p_type, p_retailprice FROM part)"""
