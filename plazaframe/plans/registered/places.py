"""Questions about places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.functions import text
from plazaframe.plans import business
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, line_reviews, order_places, part_places, roles, supplier_places


@query(
    "filter_group_top",
    """SELECT o_orderpriority AS city, count(o_orderkey) AS open_business_count
       FROM orders WHERE o_orderstatus = 'F'
       GROUP BY o_orderpriority ORDER BY open_business_count DESC, city LIMIT 10""",
)
def _(t: Tables) -> DataFrame:
    places = roles(
        t.orders, business_id="o_orderkey", city="o_orderpriority", is_open=text.flag(F.col("o_orderstatus") == "F")
    )
    return business.cities_by_open_places(places)


@query(
    "topk_per_group_rank",
    """SELECT * REPLACE (CAST(rank_in_state AS INTEGER) AS rank_in_state) FROM (
         SELECT c_mktsegment AS state, c_name AS name, o_orderpriority AS city, c_acctbal AS stars,
                o_totalprice AS review_count,
                rank() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC) AS rank_in_state
         FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')
       WHERE rank_in_state <= 5""",
)
def top_orders_per_segment(t: Tables) -> DataFrame:
    return business.most_reviewed_per_state(order_places(t))


@query(
    "join_group_avg",
    """SELECT r_name AS state, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_review_stars,
              count(l_orderkey) AS total_reviews
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name""",
)
def _(t: Tables) -> DataFrame:
    return business.stars_per_state(supplier_places(t), line_reviews(t))


@query(
    "join_group_having_top",
    """SELECT s_suppkey AS business_id, s_name AS name, n_name AS city, count(l_orderkey) AS total_reviews,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_stars
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE r_name = 'ASIA' GROUP BY s_suppkey, s_name, n_name HAVING count(l_orderkey) >= 100
       ORDER BY total_reviews DESC, business_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    return business.most_reviewed_in_state(supplier_places(t), line_reviews(t), state="ASIA")


@query(
    "group_avg_delta",
    """WITH means AS (
         SELECT s_nationkey AS k, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS m
         FROM supplier GROUP BY s_nationkey)
       SELECT s_name AS name, n_name AS city, r_name AS state, s_acctbal AS stars, m AS city_avg_stars,
              s_acctbal - m AS diff_from_city_avg
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            JOIN means ON k = s_nationkey
       ORDER BY diff_from_city_avg DESC, s_suppkey LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    return business.stars_against_city(supplier_places(t)).withColumn("stars", F.col("stars").cast("double"))


@query(
    "multi_predicate_contains",
    """SELECT p_name AS name, p_brand AS city, p_type AS state, p_retailprice AS stars, p_size AS review_count
       FROM part WHERE p_type <> 'ECONOMY' AND p_retailprice >= 905 AND p_size >= 10 AND contains(p_name, 'red')""",
)
def _(t: Tables) -> DataFrame:
    return business.top_open_restaurants(part_places(t), min_stars=905, min_reviews=10, category="red")


@query(
    "multi_predicate_token",
    """SELECT p_name AS name, p_brand AS city, p_type AS state, p_retailprice AS stars, p_size AS review_count
       FROM part WHERE p_type <> 'ECONOMY' AND p_retailprice >= 905 AND p_size >= 10
         AND list_contains(string_split(p_name, ' '), 'ring')""",
)
def _(t: Tables) -> DataFrame:
    places = part_places(t)
    return business.top_open_restaurants(places, min_stars=905, min_reviews=10, category="ring", whole_category=True)
