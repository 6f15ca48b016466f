"""Questions about reviews, and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.operators import ranking, sequence
from plazaframe.plans import review
from plazaframe.plans.registered.registry import query
from plazaframe.plans.sample_tables import Tables, day_text, line_reviews, part_places, roles, second_text, supplier_places


@query(
    "sum_predicate_top",
    """SELECT l_orderkey AS review_id, l_suppkey AS business_id, l_partkey AS user_id, l_quantity AS stars,
              l_extendedprice AS useful, l_discount AS funny, l_tax AS cool, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date
       FROM lineitem WHERE l_extendedprice + l_discount + l_tax > 1000 AND l_quantity >= 4
       ORDER BY useful DESC, review_id, business_id, user_id, stars, funny, cool, date LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    found = review.highly_voted_reviews(line_reviews(t), more_than=1000)
    return found.withColumn("stars", F.col("stars").cast("double"))


@query(
    "monthly_volume",
    """SELECT strftime(l_shipdate, '%Y-%m') AS year_month, count(l_orderkey) AS review_count,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_stars
       FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m')""",
)
def _(t: Tables) -> DataFrame:
    return review.reviews_by_month(line_reviews(t))


@query(
    "latest_per_key",
    """SELECT o_custkey AS business_id, o_orderkey AS review_id, o_custkey AS user_id, o_totalprice AS stars,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, 1 AS recency_rank
       FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) = 1
       ORDER BY date, business_id LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    reviews = roles(
        t.orders,
        business_id="o_custkey",
        review_id="o_orderkey",
        user_id="o_custkey",
        stars="o_totalprice",
        date=day_text("o_orderdate"),
    )
    return review.latest_review_per_place(reviews)


@query(
    "latest_per_key_all",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def _(t: Tables) -> DataFrame:
    newest = ranking.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "top_entities_with_avg",
    """SELECT business_id, total_reviews, avg_review_stars, s_name AS name, n_name AS city, r_name AS state, s_acctbal AS stars
       FROM (SELECT l_suppkey AS business_id, count(l_orderkey) AS total_reviews,
                    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_review_stars
             FROM lineitem GROUP BY l_suppkey)
            JOIN supplier ON business_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
       WHERE total_reviews >= 50 ORDER BY total_reviews DESC, business_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    found = review.most_reviewed_places(supplier_places(t), line_reviews(t))
    return found.withColumn("stars", F.col("stars").cast("double"))


_PART_REVIEWS = """SELECT p_name AS name, p_brand AS city, p_type AS state, l_quantity AS stars, l_extendedprice AS useful,
              l_discount AS funny, l_tax AS cool, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity = 50 AND {about}
       ORDER BY useful DESC, l_orderkey, name, city, state, stars, funny, cool, date LIMIT 30"""


@query("token_join_top", _PART_REVIEWS.format(about="contains(p_name, 'red')"))
def _(t: Tables) -> DataFrame:
    found = review.five_star_food_reviews(part_places(t), line_reviews(t, "l_partkey"), category="red", stars=50)
    return found.withColumn("stars", F.col("stars").cast("double"))


@query("token_join_exact", _PART_REVIEWS.format(about="list_contains(string_split(p_name, ' '), 'ring')"))
def _(t: Tables) -> DataFrame:
    found = review.five_star_food_reviews(
        part_places(t), line_reviews(t, "l_partkey"), category="ring", stars=50, whole_category=True
    )
    return found.withColumn("stars", F.col("stars").cast("double"))


@query(
    "running_count_head",
    """SELECT user_id AS business_id, event_id AS review_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
              value AS stars,
              count(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cumulative_reviews
       FROM events ORDER BY user_id, ts, event_id LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    reviews = roles(t.events, business_id="user_id", review_id="event_id", date="ts", stars="value")
    return review.cumulative_reviews(reviews).withColumn("date", second_text("date"))


@query(
    "running_count",
    """SELECT event_id, user_id, count(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS UNBOUNDED PRECEDING) AS cumulative FROM events""",
)
def _(t: Tables) -> DataFrame:
    visits = t.events.select("user_id", "ts", "event_id")
    return sequence.running_count(visits, ["user_id"], ["ts"], "event_id", "cumulative").drop("ts")


@query(
    "running_count_hot_key",
    """SELECT event_id, event_type, count(nullif(user_id, 8)) OVER (PARTITION BY event_type ORDER BY ts, event_id
              ROWS UNBOUNDED PRECEDING) AS cumulative FROM events""",
)
def _(t: Tables) -> DataFrame:
    """Five types share all events, so each counts as hot and is split."""
    visits = t.events.select("event_type", "ts", "event_id", F.nullif("user_id", F.lit(8)).alias("counted"))
    found = sequence.running_count(
        visits, ["event_type"], ["ts", "event_id"], "counted", "cumulative", hot_rows=10, slices=16
    )
    return found.select("event_id", "event_type", "cumulative")
